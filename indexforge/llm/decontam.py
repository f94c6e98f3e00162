"""Benchmark decontamination by broadcast n-gram sets.

Words are normalised (A-Z lower-cased, everything but letters, digits and non-ASCII separates).
A window is ``width`` consecutive words of a benchmark item, or all words of a shorter item.  A
document word inside any occurrence of a window is hit.

A window of m words that occurs in a document covers an aligned block of b = ceil(m / 2) words
(one whose first word's index is a multiple of b), and the first such block starts at most b - 1
words into the window.  So it is enough to scan the documents' aligned blocks, one in b words, against
the set of the windows' b-word pieces; a block carries the few words around it, so a hit is
verified word by word without going back to the text.  Shorter items use a shorter
block; there are at most ``width`` window lengths.

Scale: the scan is one pass over the texts with no shuffle of text.  The set of pieces is broadcast
only if its counted rows are within ``max_broadcast_rows`` (16 bytes each, and a verified
window's words besides); beyond that the same join is left to Spark, which shuffles and
splits hot pieces.  What is grouped afterwards are hits: distinct (document, start), combined before the
shuffle.

Defined results: null, empty and wordless texts have 0 words and no hit; an empty benchmark
hits nothing; every row is a document with a result of its own, so rows that repeat an id (or have none) are
judged by their own text each and equal rows get equal results; an item without an id hits like any other and is a null entry (the
first) of ``items``; items without words have no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexforge.llm.text import let, lower_az, stored

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def norm_words(text: Column) -> Column:
    """Normalised words; empty for null and wordless texts."""
    t = F.regexp_replace(lower_az(F.coalesce(text, F.lit(""))), "^" + SEPARATORS, "")
    w = F.split(t, SEPARATORS)
    # the text may end in separators: then the last piece is empty
    return F.when(t == "", F.array().cast("array<string>")).when(
        F.element_at(w, -1) == "", F.slice(w, F.lit(1), F.size(w) - 1)).otherwise(w)


def _piece(words: Column, start: Column, n: Column | int) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def _text_mark(text: str) -> Column:
    """With the id, what names a row: rows of one id and different texts are documents of their own."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _items(item: Column, collect) -> Column:
    """``collect`` of the item ids with the null one, which it would leave out by itself."""
    return F.transform(F.sort_array(collect(F.struct(item.alias("item")))), lambda x: x["item"])


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", width: int = 10) -> DataFrame:
    """Distinct (window, m) of all items with the items that hold it."""
    b = benchmark.select(F.col(item).cast("string").alias("item"), norm_words(F.col(text)).alias("w"))
    b = b.filter(F.size("w") > 0).withColumn("m", F.least(F.size("w"), F.lit(width)))
    b = b.select("item", "m", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("m") + 1),
        lambda i: _piece(F.col("w"), i, F.col("m")))).alias("window"))
    return b.groupBy("window", "m").agg(_items(F.col("item"), F.collect_set).alias("items"))


def _blocks(words: Column, m: int) -> Column:
    """The aligned blocks of one window length: (m, hash, first word's index, words around)."""
    b = (m + 1) // 2
    n = F.size(words)
    starts = F.when(n >= m, F.sequence(F.lit(0), n - b, F.lit(b))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda p: F.struct(
        F.lit(m).alias("m"), F.xxhash64(F.slice(words, p + 1, b)).alias("h"), p.alias("p"),
        F.slice(words, F.greatest(p - b + 2, F.lit(1)), F.least(p, F.lit(b - 1)) + m).alias("around")))


def find_hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
              item: str = "item_id", item_text: str = "text", *, width: int = 10,
              max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row per row of ``docs``: key, n_words, hit ``spans`` (s, e in words, merged) and ``items``."""
    return _found(docs, benchmark, key, text, item, item_text, width, max_broadcast_rows).drop("__mark")


def _found(docs: DataFrame, benchmark: DataFrame, key: str, text: str, item: str = "item_id",
           item_text: str = "text", width: int = 10, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """``find_hits`` with ``__mark``, which tells rows of one id (or of none) apart."""
    win = stored(windows(benchmark, item, item_text, width), "windows")
    lengths = sorted(r["m"] for r in win.select("m").distinct().collect())  # at most ``width`` rows
    half = F.ceil(F.col("m") / 2).cast("int")
    pieces = win.select("window", "m", "items", F.split("window", " ").alias("ww"), half.alias("b"))
    pieces = pieces.select("window", "m", "items", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("b") - 1), lambda k: F.struct(
            k.alias("k"), F.xxhash64(F.slice("ww", k + 1, F.col("b"))).alias("h")))).alias("x")).select(
                F.col("x.h").alias("h_"), F.col("m").alias("m_"), F.col("x.k").alias("k"), "window", "items")
    keys = stored(pieces.select("h_", "m_").distinct(), "window_pieces")
    small = keys.count() <= max_broadcast_rows
    wide = F.broadcast if small else (lambda x: x)

    none = "array<struct<m:int,h:bigint,p:int,around:array<string>>>"
    words = docs.select(F.col(key).alias("key"), _text_mark(text).alias("un"), norm_words(F.col(text)).alias("w"))
    blocks = F.concat(F.array().cast(none), *[_blocks(F.col("w"), m) for m in lengths])
    # the first entry of a row carries the number of words
    total = F.array(F.struct(F.lit(None).cast("int").alias("m"), F.lit(None).cast("bigint").alias("h"),
                             F.size("w").alias("p"), F.lit(None).cast("array<string>").alias("around")))
    rows = words.select("key", "un", F.explode(F.concat(total, blocks)).alias("x")).select("key", "un", "x.*")
    rows = rows.join(wide(keys), (F.col("h") == F.col("h_")) & (F.col("m") == F.col("m_")), "left")
    rows = rows.filter(F.col("m").isNull() | F.col("h_").isNotNull()).drop("h_", "m_")
    rows = stored(rows, "window_hits")

    lead = F.least(F.col("p"), F.ceil(F.col("m") / 2).cast("int") - 1)  # words before the block
    hits = rows.filter("m is not null").join(pieces, (F.col("h") == F.col("h_")) & (F.col("m") == F.col("m_")))
    hits = hits.filter((F.col("k") <= lead) & (_piece(F.col("around"), lead - F.col("k") + 1, F.col("m"))
                                               == F.col("window")))
    starts = hits.select("key", "un", (F.col("p") - F.col("k")).alias("s"),
                         (F.col("p") - F.col("k") + F.col("m")).alias("e")).distinct()
    kind = "array<struct<s:int,e:int>>"
    merged = F.aggregate(
        F.sort_array("all"), F.array().cast(kind),
        lambda a, x: F.when((F.size(a) > 0) & (F.element_at(a, -1)["e"] >= x["s"]), F.concat(
            F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
                F.element_at(a, -1)["s"].alias("s"),
                F.greatest(F.element_at(a, -1)["e"], x["e"]).alias("e"))))).otherwise(
                    F.concat(a, F.array(x))))
    spans = starts.groupBy("key", "un").agg(F.collect_list(F.struct("s", "e")).alias("all")).select(
        "key", "un", merged.alias("spans"))
    items = hits.select("key", "un", F.explode("items").alias("item")).distinct().groupBy("key", "un").agg(
        _items(F.col("item"), F.collect_list).alias("items")).select(
            F.col("key").alias("key_"), F.col("un").alias("un_"), "items")
    base = rows.filter("m is null").select("key", "un", F.col("p").cast("long").alias("n_words"))  # a row per row
    same = F.col("key").eqNullSafe(F.col("key_")) & (F.col("un") == F.col("un_"))
    found = stored(spans.join(items, same, "left").select("key", "un", "spans", "items"), "found").select(
        F.col("key").alias("key_"), F.col("un").alias("un_"), "spans", "items")
    return base.join(found, same, "left").select(
        F.col("key").alias(key), "n_words", F.coalesce("spans", F.array().cast(kind)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("un").alias("__mark"))


def _same_document(key: str, text: str) -> Column:
    """Rows of a table against (__key, __mark) of ``_found``."""
    return F.col(key).eqNullSafe(F.col("__key")) & (_text_mark(text) == F.col("__mark"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  **params) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    bad = _found(docs, benchmark, key, text, **params).filter(F.size("spans") > 0).select(
        F.col(key).alias("__key"), "__mark")
    return docs.join(bad, _same_document(key, text), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 **params) -> DataFrame:
    """``docs`` with the hit words, and the separators before them, cut out of the text."""
    hits = _found(docs, benchmark, key, text, **params).filter(F.size("spans") > 0).select(
        F.col(key).alias("__key"), "__mark", F.col("spans").alias("__spans")).dropDuplicates(["__key", "__mark"])
    j = docs.join(hits, _same_document(key, text), "left")
    parts = F.regexp_extract_all(F.col(text), F.lit("[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*"
                                                    "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"), F.lit(0))
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.exists(
        "__spans", lambda s: (s["s"] <= i) & (i < s["e"]))), "")
    return j.withColumn(text, F.when(F.col("__spans").isNull(), F.col(text)).otherwise(kept)).drop(
        "__key", "__mark", "__spans")
