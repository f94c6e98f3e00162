"""Source divergence audit with hash-consed segment trees over term ids.

Terms are runs of letters (ASCII letters, lower-cased, and every character beyond ASCII).  A language keeps the V
terms that ``min_docs`` of its rows hold.  A group (language, source) and each language give a kept term the
integer p = 1 + floor(SCALE * (count + 5) / (N + 5V)).  The audit prices every pair of sources of a language at
the sum of |p - q| over all kept terms, and lists each group's most over-represented terms.

1. Counting: tasks count terms per group in dictionaries of bounded size, so a frequent term or a large
   group costs a row per flush of a task; the sums are combined before and after one shuffle.
2. Term ids: kept terms are dealt by hash to segments of about ``SEGMENT`` terms and ranked by frequency
   inside theirs, so that rare terms, alike in most sources, are neighbours.  A segment is a
   subtree of each group's tree; its root's price is a partial sum.
3. Trees: a task holds one segment of a block of sources (two blocks for pairs across blocks).  Leaves are counts,
   a node is the pair of its children's identifiers, and equal pairs get one identifier, whatever group or
   place they come from (hash-consing, level by level).
4. Traversal: for a source and all others the pairs of root identifiers are followed down together; at each level
   equal pairs of nodes are one entry (the memo), so identical subtrees are priced once, and prices are
   summed on the way up.
5. Segments' prices are added per pair of sources.

Integers only.  Products stay below 2**63 for languages of up to 9e15 kept occurrences.

Defined results: null text, language and source count as ''; every row is a document (repeated ones
too); a group without terms has N = 0 and is paired like any other; a language without kept terms prices its
pairs at 0 and lists no terms; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indexforge.llm.text import dropped, stored

SCALE, SMOOTH = 1_000_000_000, 5
#: Terms of a segment, sources of a block.
SEGMENT, BLOCK = 4096, 64
#: Distinct (group, term) entries a task holds before it sends them on; bytes of text parted at once.
HELD, PIECE = 400_000, 1 << 20
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in pieces of about ``PIECE`` bytes."""
    at = 0
    while at < len(text):
        to = at + PIECE
        if to < len(text):
            part = text[at:to].translate(_TERM_BYTES)
            cut = part.rfind(b" ", 1)
            while cut < 0 and to < len(text):  # one term fills the piece
                to += PIECE
                part = text[at:to].translate(_TERM_BYTES)
                cut = part.rfind(b" ", 1)
            to = at + cut if cut >= 0 and to < len(text) else to
        yield text[at:to].translate(_TERM_BYTES).split()
        at = to


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs); the term '' stands for the group itself."""
    counts: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), c in counts.items():
            d = docs[lang, source]
            terms = [b"", *c.keys()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                 pa.array(terms, pa.binary()).cast(pa.string()), pa.array([0, *c.values()], pa.int64()),
                 pa.array([0, *(d[t] for t in c)], pa.int64())], names=["lang", "source", "term", "n", "docs"])
        counts.clear()
        docs.clear()

    held = 0
    for b in batches:
        for group, text in zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True), b.column(2), strict=True):
            c, before, own = counts[group], len(counts[group]), set()
            for words in _terms(text.as_buffer().to_pybytes()):
                c.update(words)
                own.update(words)
            docs[group].update(own)
            held += len(c) - before
            if held > HELD:
                yield from flush()
                held = 0
    yield from flush()


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (n + SMOOTH) / total), by long division in base 1000."""
    out, rest = np.zeros(np.broadcast(n, total).shape, np.int64), (n + SMOOTH).astype(np.int64)
    for _ in range(3):
        q, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + q
    return out + 1


def consed(leaves: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Trees over the rows of ``leaves`` (groups x 2**k counts, -1 beyond the last term).

    Returns the root of each row, per level from the top the (left, right) children of every node, and
    the count of every leaf node.
    """
    counts, ids = np.unique(leaves, return_inverse=True)
    ids, levels = ids.reshape(leaves.shape), []
    while ids.shape[1] > 1:
        base = int(ids.max()) + 1
        nodes, up = np.unique(ids[:, ::2] * base + ids[:, 1::2], return_inverse=True)
        levels.append((nodes // base, nodes % base))
        ids = up.reshape(len(ids), -1)
    return ids[:, 0], levels[::-1], counts


def prices(root: int, others: np.ndarray, levels, counts: np.ndarray, own: int, totals: np.ndarray) -> np.ndarray:
    """The sum of |p - q| between one tree and each of ``others``; equal node pairs of a pair of groups are priced once."""
    pair, x, y = np.arange(len(others)), np.full(len(others), root), others
    back = []
    for left, right in levels:
        pair, x, y = np.tile(pair, 2), np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
        size = max(int(x.max()), int(y.max())) + 1
        key, where = np.unique((pair * size + x) * size + y, return_inverse=True)
        pair, x, y = key // (size * size), key // size % size, key % size
        back.append(where)
    a, b = counts[x], counts[y]
    there = a >= 0
    value = np.zeros(len(a), np.int64)
    value[there] = np.abs(shares(a[there], np.int64(own)) - shares(b[there], totals[pair[there]]))
    for where in back[::-1]:
        value = value[where].reshape(2, -1).sum(axis=0)
    return value


def _price_block(key: tuple, rows: pa.Table) -> pa.Table:
    """Partial prices of the pairs of sources of one segment: within a block, or of one block with another."""
    lang, _, first, second = (k.as_py() for k in key)
    rows = rows.sort_by("source")
    source, block, total = rows["source"].to_pylist(), rows["block"].to_numpy(), rows["total"].to_numpy()
    width = rows["width"][0].as_py()
    leaves = np.full((len(source), 1 << max(0, width - 1).bit_length()), -1, np.int64)
    leaves[:, :width] = 0
    for k, (at, n) in enumerate(zip(rows["at"], rows["n"], strict=True)):
        if at.is_valid:
            leaves[k, at.values.to_numpy()] = n.values.to_numpy()
    roots, levels, counts = consed(leaves)
    a, b, value = [], [], [np.zeros(0, np.int64)]
    for k in np.flatnonzero(block == first).tolist():
        others = np.flatnonzero((block == second) & ((first != second) | (np.arange(len(source)) > k)))
        if len(others):
            a += [source[k]] * len(others)
            b += [source[x] for x in others.tolist()]
            value.append(prices(int(roots[k]), roots[others], levels, counts, int(total[k]), total[others]))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.string()),
                     "b": pa.array(b, pa.string()), "value": pa.array(np.concatenate(value))})


def _share(n, total):
    """p as a column: decimals, so that no product overflows."""
    whole = (F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTH).cast("decimal(19,0)"))
    return F.call_function("div", whole, total.cast("decimal(19,0)")) + F.lit(1)


def divergence(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
               min_docs: int = 30, top: int = 50, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): the distances to the language's other sources (part ``pair``)
    and the ``top`` over-represented terms (part ``term``) of every group."""
    d = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for k, c in (
        ("lang", lang), ("source", source), ("text", text))])
    counts = stored(d.mapInArrow(_count, "lang string, source string, term string, n long, docs long").groupBy(
        "lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term_counts")
    terms = counts.filter("term <> ''").groupBy("lang", "term").agg(
        F.sum("n").alias("in_lang"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).drop("docs")
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("in_lang").alias("lang_n"))
    terms = stored(terms.join(sizes, "lang").withColumn(
        "seg", F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / segment)).cast("int")).repartition("lang", "seg").withColumn(
        "at", F.row_number().over(Window.partitionBy("lang", "seg").orderBy(F.desc("in_lang"), "term")) - 1), "terms")
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("in_lang").alias("lang_n"))
    kept = stored(counts.withColumnRenamed("n", "k").join(terms, ["lang", "term"]).select(
        "lang", "source", "seg", "at", "term", F.col("k").alias("n"), "in_lang"), "kept_counts")
    groups = counts.filter("term = ''").select("lang", "source").join(
        kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left").join(
        sizes, "lang", "left").na.fill(0).withColumn("total", F.col("group_n") + SMOOTH * F.col("v"))
    groups = stored(groups, "groups")
    dropped(counts)

    # the pairs of sources: a row per group and segment, sent to its block's pairs
    of_lang = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    widths = terms.groupBy("lang", "seg").agg(F.count(F.lit(1)).cast("int").alias("width"))
    rows = groups.join(of_lang, "lang").select(
        "lang", "source", "total", "blocks",
        F.pmod(F.xxhash64("source"), "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("v") / segment).cast("int") - 1, F.lit(0)))).alias("seg"))
    vectors = kept.groupBy("lang", "source", "seg").agg(F.collect_list(F.struct("at", "n")).alias("x")).select(
        "lang", "source", "seg", F.col("x.at").alias("at"), F.col("x.n").alias("n"))
    rows = rows.join(vectors, ["lang", "source", "seg"], "left").join(widths, ["lang", "seg"], "left").na.fill(0, ["width"])
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({
        "first": F.least("block", "other"), "second": F.greatest("block", "other")})
    half = rows.select("lang", "seg", "first", "second", "source", "block", "total", "width", "at", "n").groupBy(
        "lang", "seg", "first", "second").applyInArrow(_price_block, "lang string, a string, b string, value long")
    half = half.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = half.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        half.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    over = kept.filter("n > 0").join(groups.select("lang", "source", "total", "v", "lang_n"), ["lang", "source"])
    over = over.select("lang", "source", F.col("term").alias("item"), (
        _share(F.col("n"), F.col("total")) - _share(F.col("in_lang"), F.col("lang_n") + SMOOTH * F.col("v"))).alias("value"))
    listed = over.filter("value > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(listed.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
