"""Rejected rows -> JSON lines ``{date, timestamp, data: {ticker, payload}}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexforge.functions.calendar import date_text


def dead_letter_records(rejected: DataFrame, run_ts: str) -> DataFrame:
    """One JSON line per rejected bar; the payload is the original entry."""
    payload = F.try_parse_json(F.col("_payload"))
    rec = F.struct(
        date_text("request_date").alias("date"),
        F.lit(str(run_ts)).alias("timestamp"),
        F.struct(F.col("ticker").alias("ticker"),
                 F.coalesce(payload, F.col("_payload").cast("variant")).alias("payload"),
                 F.col("_reason").alias("reason")).alias("data"))
    return rejected.select(F.to_json(rec).alias("value"), F.col("request_date"))


def write_dead_letters(rejected: DataFrame, path: str, run_ts: str) -> None:
    """Idempotent per load: the caller passes a folder unique to the load and it
    is overwritten if the load is retried."""
    dead_letter_records(rejected, run_ts).select("value").write.mode("overwrite").text(path)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    v = F.try_parse_json("value")
    return (spark.read.option("recursiveFileLookup", "true").text(path)
            .select(F.try_variant_get(v, "$.date", "string").alias("date"),
                    F.try_variant_get(v, "$.timestamp", "string").alias("timestamp"),
                    F.try_variant_get(v, "$.data.ticker", "string").alias("ticker"),
                    F.try_variant_get(v, "$.data.reason", "string").alias("reason"),
                    F.try_variant_get(v, "$.data.payload", "variant").alias("payload")))
