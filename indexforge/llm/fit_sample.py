"""The bounded, labelled sample that the trained operators fit on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexforge.llm.text import fold_bucket

#: Rows and bytes of an Arrow batch handed to Python: they bound a worker's memory when texts are long
#: and keep batches of small rows large.
BATCH_ROWS, BATCH_BYTES = 20_000, 1 << 20


def small_batches(spark) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, folds: int, held_out: int,
                    key: str = "doc_id", text: str = "text", max_rows: int = 4000) -> list[tuple[str, int]]:
    """At most ``max_rows`` (text, label) pairs outside the held-out fold, by a hash of the key: whole texts,
    however long.  The key only picks rows and is not returned.  Null labels are skipped.
    """
    pick = (labels.select(F.col(key).alias("key_"), F.col(label).cast("int").alias("y"))
            .filter(F.col("y").isNotNull() & (fold_bucket(F.col("key_"), folds) != held_out))
            .orderBy(F.xxhash64(F.lit(label), F.col("key_").cast("string")), "key_").limit(max_rows))
    # at most max_rows small rows: their size is bounded by the parameter
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(
        F.broadcast(pick), F.col("key") == F.col("key_"))
    rows = rows.select("key", "text", "y").orderBy("key", "text").limit(max_rows)
    return [(r["text"], r["y"]) for r in rows.collect()]
