"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources, by code point with null last, weigh 5, 2, 1, repeating, and share
``share`` x all words; a target stops at ``max_epochs`` x its source's words and the excess is
shared anew by weight until none is above (water filling).  Filled amounts are
min(cap, level x weight), so the level follows from the sources in order of cap / weight.

Documents: inside a source the order is a hash of (doc_id, text), so reruns agree.  A target
takes whole passes over the source and then, in that order, the documents whose middle lies before the
rest of the target, so a source misses its target by half a document at most.

Curriculum: source k's share of the training stream changes over the time t in [0, 1] as
``1 + slope_k (2 t - 1)``, with slopes that alternate in sign.  Its integral up to t is the part
of the target wanted by then; inverting it at each document's cumulative words gives
the training position of each taken copy.  Documents are range-sorted by position.

Scale: nothing but the table of sources (one row per source) is ever in one task.  Cumulative
words come from sums per (source, hash bucket), the running sum over buckets, and a window inside one
bucket; the number of buckets grows with the rows, so a source with a third of all rows is split.

Defined results: a null text has 0 words and takes 0; an empty table gives an empty result;
repeated rows of one doc_id are documents of their own; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexforge.llm.text import stored, ws_words

#: The repeating weights and the slopes of the schedules.
WEIGHTS = [5, 2, 1]
SLOPES = [-0.5, 0.5, 0.0]
ROWS_PER_BUCKET = 5_000


def source_targets(sizes: DataFrame, share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """(source, source_size, weight, slope, target) from (source, source_size).

    One row per source: the windows below run in one task over that small table.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(order) - 1) % len(WEIGHTS)
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), k + 1)
    s = sizes.select("source", "source_size", pick(WEIGHTS).alias("weight"), pick(SLOPES).alias("slope"))
    s = s.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    s = s.withColumn("budget", share * F.sum("source_size").over(everything))
    s = s.withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(filled), F.lit(0.0)))
                     / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0))))
    # the first source, in order of cap / weight, that its level does not fill sets the level
    # (the largest: levels only fall after it)
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything)
    return s.select("source", "source_size", "weight", "slope",
                    F.least("cap", F.coalesce(level, F.lit(float("inf"))) * F.col("weight")).alias("target"))


def position(part: Column, slope: Column) -> Column:
    """The time t at which the integral t + slope (t^2 - t) of a schedule reaches ``part``."""
    b = 1 - slope
    return F.when(slope == 0, part).otherwise(
        (F.sqrt(b * b + 4 * slope * part) - b) / (2 * slope))


def _placed(docs: DataFrame, key: str, source: str, text: str, share: float, max_epochs: int, whole: bool) -> DataFrame:
    """(key, size, source_size, target, copies, positions) per row, and the row itself if ``whole``."""
    narrow = [F.col(key).alias("key"), F.col(source).alias("source"),
              F.size(ws_words(F.col(text))).cast("long").alias("size"),
              F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("h")]
    small = stored(docs.select(*narrow), "mix_sizes")
    d = docs.select(*narrow, F.struct(*docs.columns).alias("row")) if whole else small
    n = small.count()
    buckets = max(1, -(-n // ROWS_PER_BUCKET))
    # buckets are ranges of the hash, so they are in the order of the hash
    bucket = F.floor((F.col("h").cast("double") / 2.0 ** 64 + 0.5) * buckets).cast("long")
    bucket = F.least(F.greatest(bucket, F.lit(0)), F.lit(buckets - 1)).cast("long")
    d = d.withColumn("bucket", bucket)
    sums = small.withColumn("bucket", bucket).groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, share, max_epochs)
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0).cast("long")))
    base = base.join(targets.withColumnRenamed("source", "source_"),
                     F.col("source").eqNullSafe(F.col("source_"))).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "before", "source_size", "slope", "target")
    inside = Window.partitionBy("source", "bucket").orderBy("h", "key").rowsBetween(
        Window.unboundedPreceding, -1)
    d = d.withColumn("here", F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))
    d = d.join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    start = F.col("before") + F.col("here")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    passes = F.least(passes.cast("long"), F.lit(max_epochs).cast("long"))
    rest = F.col("target") - passes * F.col("source_size")
    copies = F.when(F.col("size") == 0, 0).otherwise(
        passes + F.when((passes < max_epochs) & (start + F.col("size") / 2 <= rest), 1).otherwise(0)).cast("long")
    d = d.withColumn("start", start).withColumn("copies", copies)
    at = F.transform(F.filter(F.sequence(F.lit(0), F.lit(max_epochs - 1)), lambda i: i < F.col("copies")),
                     lambda i: position(F.least(F.lit(1.0), (i * F.col("source_size") + F.col("start"))
                                                / F.col("target")), F.col("slope")))
    return d.withColumn("positions", at)


def mix_sources(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", *,
                share: float = 1.5, max_epochs: int = 2, sort: bool = True) -> DataFrame:
    """One row per document: sizes, target, words taken, copies and the position of each copy."""
    d = _placed(docs, key, source, text, share, max_epochs, whole=False)
    out = d.select(F.col("key").alias(key), "size", "source_size", "target",
                   (F.col("copies") * F.col("size")).alias("taken"), "copies", "positions")
    return out.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), key) if sort else out


def curriculum_documents(docs: DataFrame, key: str = "doc_id", source: str = "source",
                         text: str = "text", *, share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """The training stream: a row of ``docs`` per taken copy with ``__copy`` and ``__position``, range-sorted
    by position.  Rows are carried along, not joined back, so null and repeated ids lose nothing."""
    d = _placed(docs, key, source, text, share, max_epochs, whole=True).filter("copies > 0")
    d = d.select("row", F.posexplode("positions").alias("__copy", "__position"))
    return d.select(*[F.col("row")[c].alias(c) for c in docs.columns], "__copy", "__position").orderBy(
        "__position", key, "__copy")
