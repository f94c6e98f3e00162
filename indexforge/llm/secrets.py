"""Secret scans: fixed patterns, and character Markov models for what they miss.

The patterns find assignments, access ids and hexadecimal strings.  Two first-order Markov models over
ASCII characters, one of random strings and one of ordinary identifiers, are trained from
labelled samples; a long token whose mean log-likelihood ratio per transition reaches
``min_ratio`` is a span of kind ``random`` unless a pattern's span already holds it.  Of a token that
pattern spans hold in part, the rest is judged by the same ratio over all its pieces, and each
piece is a span; a rest of fewer characters than a long token has is not judged.  Tokens are judged from the
length on that the default samples are trained on.

The default samples do not come from the patterns.  Random strings are drawn (digests of running numbers,
spelt in the alphabets that keys are spelt in); ordinary identifiers are made of the corpus: neighbouring words of
at most ``sample_rows`` texts, joined by the signs that join words in names, and the long tokens of those texts that
no pattern holds.  What reaches the driver is a table of at most 2 x 128 x 128 counts.

Scale: training reads the texts once for a bounded sample (a partial top-k by a hash), scanning is one pass of
built-in expressions per row; nothing is shuffled by document, source or value.

Defined results: a null or empty text has no spans (and the digest of an empty string); spans are
in code points, end exclusive; repeated rows get a row each; without samples of one kind
no random span is added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexforge.llm.text import let

#: The patterns by kind, in their order, and the least length of a match.
ASSIGN = ("(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
          "([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]
TOKEN = "[A-Za-z0-9+/_-]{%d,}={0,2}"
ASCII = 128
SPANS = "array<struct<s:int,e:int,k:int,v:string>>"


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches as structs (s, e, k, v): split gives what lies between."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    k = F.lit(KINDS.index(kind))
    kind_of = "array<struct<s:int,e:int,k:int,v:string>>"
    walk = let(between, lambda gap: F.aggregate(
        F.transform(found, lambda v, i: F.struct(v.alias("v"), F.get(gap, i).alias("g"))),
        F.struct(F.lit(0).alias("at"), F.array().cast(kind_of).alias("out")),
        lambda a, m: let(a["at"] + m["g"], lambda s: F.struct(
            (s + F.length(m["v"])).alias("at"),
            F.concat(a["out"], F.array(F.struct(s.alias("s"), (s + F.length(m["v"])).alias("e"),
                                                k.alias("k"), m["v"].alias("v")))).alias("out"))),
        lambda a: a["out"]))
    return F.when(text.rlike(pattern), walk).otherwise(F.array().cast(kind_of))


def base_spans(text: Column, min_value: int = 6) -> Column:
    """Spans of the three patterns, by start and then kind."""
    assign = F.filter(_matches(text, ASSIGN, "assign"),
                      lambda m: F.length(F.regexp_extract(m["v"], ASSIGN, 2)) >= min_value)
    return F.sort_array(F.concat(assign, _matches(text, ACCESS, "access"), _matches(text, HEX, "hex")))


def _transitions(token: Column) -> Column:
    """Codes 128 * a + b of neighbouring characters."""
    return let(F.transform(F.split(token, ""), lambda c: F.ascii(c)), lambda c: F.transform(
        F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))),
        lambda x, i: x * ASCII + F.get(c, i + 1)))


def drawn_strings(spark, n: int = 2000) -> DataFrame:
    """(value, secret) of ``6 * n`` random strings of 40 characters or so."""
    d = spark.range(0, n, 1, 4).select(F.unhex(F.sha2(F.concat(F.lit("drawn"), F.col("id")), 512)).alias("b"))
    base = F.base64("b")
    letters = F.regexp_replace(base, "[+/=\\s]", "")
    spelt = [base, F.translate(base, "+/=", "-_"), letters, F.upper(letters), F.lower(letters), F.hex("b")]
    return d.select(F.explode(F.array(*[F.substring(x, 1, 40) for x in spelt])).alias("value"), F.lit(True).alias("secret"))


def ordinary_identifiers(texts: DataFrame, min_length: int, sample_rows: int = 1000) -> DataFrame:
    """(value, secret) from rows (key, text, base): names joined of neighbouring words, and long tokens that no
    pattern holds, of at most ``sample_rows`` texts picked by a hash."""
    pick = texts.orderBy(F.xxhash64("key", "text"), "text").limit(sample_rows).repartition(8)
    words = F.regexp_extract_all("text", F.lit("[A-Za-z][A-Za-z0-9]*"), F.lit(0))
    signs = F.array(*map(F.lit, ("_", "-", "/", ".")))
    named = let(words, lambda ws: F.transform(ws, lambda w, i: F.call_function(
        "concat_ws", F.get(signs, i % 4), w, F.lower(F.get(ws, i + 1)), F.initcap(F.get(ws, i + 2)))))
    held = F.transform("base", lambda m: m["v"])
    tokens = F.filter(F.regexp_extract_all("text", F.lit(TOKEN % min_length), F.lit(0)),
                      lambda t: ~F.exists(held, lambda v: F.contains(t, v) | F.contains(v, t)))
    return pick.select(F.explode(F.concat(F.filter(named, lambda w: F.length(w) >= min_length), tokens)).alias("value"),
                       F.lit(False).alias("secret"))


def fit_ratios(samples: DataFrame, strength: float = 4.0) -> list[float] | None:
    """Log ratios by transition code from (value, secret); None if a kind has no sample.

    A transition's probability is smoothed towards the frequency of its second character.
    """
    rows = samples.select("secret", F.explode(_transitions(F.col("value"))).alias("t")).filter(
        F.col("t").between(0, ASCII * ASCII - 1)).groupBy("secret", "t").count().collect()
    n = {True: [0] * ASCII * ASCII, False: [0] * ASCII * ASCII}
    for r in rows:
        n[r["secret"]][r["t"]] = r["count"]
    if not any(n[True]) or not any(n[False]):
        return None
    char = {}
    for y, c in n.items():
        ends = [sum(c[b::ASCII]) + 0.5 for b in range(ASCII)]
        char[y] = [x / sum(ends) for x in ends]
    out = []
    for a in range(ASCII):
        row = {y: n[y][a * ASCII:(a + 1) * ASCII] for y in n}
        p = {y: [(row[y][b] + strength * char[y][b]) / (sum(row[y]) + strength) for b in range(ASCII)] for y in n}
        out += [round(math.log(p[True][b] / p[False][b]), 9) for b in range(ASCII)]
    return out


def random_ratio(pieces: Column, table: Column) -> Column:
    """Mean log ratio per transition of the pieces of a token; null without a transition."""
    return let(F.flatten(F.transform(pieces, lambda p: _transitions(p["v"]))), lambda t: F.try_divide(F.aggregate(
        t, F.lit(0.0), lambda a, x: a + F.coalesce(F.get(table, x), F.lit(0.0))), F.size(t)))


def _rest(token: Column, base: Column) -> Column:
    """The pieces of a token span that no span of ``base`` (sorted) holds; the token itself if none meets it."""
    meets = lambda b: (b["s"] < token["e"]) & (token["s"] < b["e"])
    piece = lambda s, e: F.struct(
        s.alias("s"), e.alias("e"), token["k"].alias("k"), F.substring(token["v"], s - token["s"] + 1, e - s).alias("v"))
    cut = F.aggregate(
        F.concat(F.transform(F.filter(base, meets), lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e"))),
                 F.array(F.struct(token["e"].alias("s"), token["e"].alias("e")))),
        F.struct(token["s"].alias("at"), F.array().cast(SPANS).alias("out")),
        lambda a, b: F.struct(F.greatest(a["at"], b["e"]).alias("at"), F.when(
            b["s"] > a["at"], F.concat(a["out"], F.array(piece(a["at"], b["s"])))).otherwise(a["out"]).alias("out")),
        lambda a: a["out"])
    return F.when(F.exists(base, meets), cut).otherwise(F.array(token))


def _scanned(docs: DataFrame, key: str, text: str, samples: DataFrame | None, min_length: int,
             sample_rows: int, min_ratio: float) -> DataFrame:
    """(key, text, base, spans) per row."""
    d = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    d = d.withColumn("base", base_spans(F.col("text")))
    if samples is None:
        samples = drawn_strings(docs.sparkSession).unionByName(ordinary_identifiers(d, min_length, sample_rows))
    ratios = fit_ratios(samples)
    if ratios is None:
        return d.withColumn("spans", F.col("base"))
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")  # folded once
    tokens = _matches(F.col("text"), TOKEN % min_length, "random")
    size = lambda pieces: F.aggregate(pieces, F.lit(0), lambda a, p: a + p["e"] - p["s"])
    more = let(F.col("base"), lambda base: F.flatten(F.filter(
        F.transform(tokens, lambda t: _rest(t, base)),
        lambda x: (size(x) >= min_length) & (random_ratio(x, table) >= min_ratio))))
    return d.withColumn("spans", F.sort_array(F.concat("base", more)))


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", *,
                 samples: DataFrame | None = None, min_length: int = 16, sample_rows: int = 1000,
                 min_ratio: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: key, ``base`` and all ``spans`` as (s, e, k, v) structs."""
    s = _scanned(docs, key, text, samples, min_length, sample_rows, min_ratio)
    return s.select(F.col("key").alias(key), "base", "spans")


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mask: str = "[secret]", *,
           samples: DataFrame | None = None, min_length: int = 16, sample_rows: int = 1000,
           min_ratio: float = 0.5) -> DataFrame:
    """(key, clean_text) per row: every span's text is replaced by ``mask``, spans that overlap as one.  Each row is
    cut by its own spans, so null and repeated ids change nothing."""
    j = _scanned(docs, key, text, samples, min_length, sample_rows, min_ratio)
    cut = F.aggregate("spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
                      lambda a, m: F.struct(
                          F.when(m["s"] >= a["at"], F.concat(a["out"], F.substring(
                              F.col("text"), a["at"] + 1, m["s"] - a["at"]), F.lit(mask))).otherwise(a["out"]).alias("out"),
                          F.greatest(a["at"], m["e"]).alias("at")),
                      lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return j.select(F.col("key").alias(key), cut.alias("clean_text"))


def span_text(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(
        ":", F.get(names, m["k"]), m["s"].cast("string"), m["e"].cast("string"))), ",")
