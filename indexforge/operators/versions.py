"""Versioned tables: every rebuild is appended with its own ``update_time``.

The latest version is chosen **per ticker** (per date and index type), not per
run, exactly as the stored queries do: rebuilding a day with fewer names leaves
the older names in, so weights of a day can sum above 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def restrict(df: DataFrame, index_type=None, date=None, start=None, end=None) -> DataFrame:
    """Filter a versioned table by index type, one date and/or a date range
    (partition and Parquet-statistics filters)."""
    if index_type is not None:
        df = df.filter(F.col("index_type") == F.lit(index_type))
    if date is not None:
        df = df.filter(F.col("date") == F.lit(str(date)).cast("date"))
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") <= F.lit(str(end)).cast("date"))
    return df


def latest_per(df: DataFrame, keys, order_col: str = "update_time") -> DataFrame:
    """Keep the newest row per key (``row_number() ... = 1``).

    Spark plans this as a partial ``WindowGroupLimit`` before the shuffle, so a
    key with many versions is cut down map-side.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc_nulls_last())
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def latest_weights(composition: DataFrame, index_type=None, start=None,
                   end=None) -> DataFrame:
    """Newest (date, ticker) row per index type.  Filters on the window's
    partition keys (index_type, date) are applied before ranking and reach the
    scan as partition filters."""
    comp = restrict(composition, index_type, start=start, end=end)
    return latest_per(comp, ["index_type", "date", "ticker"])


def snapshot_rows(composition: DataFrame, date=None, index_type=None) -> DataFrame:
    """Latest version per ticker for a date and index type (all when None), unsorted:
    the form to aggregate or combine further without a global sort."""
    snap = latest_weights(restrict(composition, index_type, date))
    return snap.select("date", "ticker", "close_price", "weight", "market_cap", "index_type")


def composition_snapshot(composition: DataFrame, date=None, index_type=None) -> DataFrame:
    """Latest version per ticker for a date and index type, weight descending
    (display order).  With ``date=None`` / ``index_type=None`` all dates / types
    come out at once."""
    return snapshot_rows(composition, date, index_type).orderBy(
        F.col("index_type"), F.col("date"), F.col("weight").desc(), F.col("ticker"))


def version_collapse_legacy(composition: DataFrame) -> DataFrame:
    """First-generation collapse: identical rows of several runs become one,
    rows that differ in price, weight or cap are all kept.

    ``GROUP BY date, ticker, close_price, weight, market_cap`` + ``MAX(update_time)``;
    the index type is kept as a grouping key because our table stores both indices.
    """
    return (composition.groupBy("index_type", "date", "ticker", "close_price",
                                "weight", "market_cap")
            .agg(F.max("update_time").alias("latest_update_time")))


def composition_snapshot_legacy(composition: DataFrame, date=None,
                                index_type=None) -> DataFrame:
    """First-generation snapshot: legacy collapse for a date, market cap descending."""
    snap = version_collapse_legacy(restrict(composition, index_type, date))
    return snap.orderBy("index_type", "date", F.col("market_cap").desc_nulls_last(), "ticker")


def performance_collapse_legacy(performance: DataFrame) -> DataFrame:
    """First-generation collapse of performance runs: group by (date, index_price),
    the daily return taken from the newest row of the group."""
    return (performance.groupBy("index_type", "date", "index_price")
            .agg(F.max_by("daily_return", "update_time").alias("daily_return"),
                 F.max("update_time").alias("latest_update_time")))


def latest_performance(performance: DataFrame, start=None, end=None,
                       index_type=None) -> DataFrame:
    """Newest stored performance row per (index_type, date)."""
    perf = restrict(performance, index_type, start=start, end=end)
    return latest_per(perf, ["index_type", "date"])
