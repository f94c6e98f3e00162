"""Composite reads: get-or-build composition and the two serving views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexforge.constants import INDEX_TYPES
from indexforge.functions.calendar import date_text
from indexforge.operators.construct import COMPOSITION_COLUMNS, build_index
from indexforge.operators.performance import performance_history
from indexforge.operators.versions import composition_snapshot, restrict, snapshot_rows
from indexforge.session import scratch_path
from indexforge.sinks.versioned import append_composition


def composition_get_or_build(stored: DataFrame, prices: DataFrame, instruments: DataFrame,
                             top_n: int, start=None, end=None,
                             index_types=INDEX_TYPES, store_path: str | None = None,
                             run_ts=None) -> DataFrame:
    """Stored snapshot for (index_type, date) pairs that have stored rows; a fresh
    build for the requested dates that have none.  The built side is limited to
    the missing pairs with an anti-join on (index_type, date).  With ``store_path`` the built
    side is appended there as run ``run_ts``, as the original's constructor does."""
    if isinstance(index_types, str):
        index_types = (index_types,)
    stored = restrict(stored, start=start, end=end).filter(F.col("index_type").isin(list(index_types)))
    snap = snapshot_rows(stored).select(*COMPOSITION_COLUMNS)
    # (index_type, date) pairs already stored: at most days x index types rows
    have = stored.select("index_type", "date").distinct()
    complete = (have.groupBy("date").agg(F.count(F.lit(1)).alias("_k"))
                .filter(F.col("_k") == len(index_types)).select("date"))
    # only dates that miss at least one index type are built
    bars = prices.join(complete, "date", "left_anti")
    built = build_index(bars, instruments, top_n, index_types, start=start, end=end)
    fresh = built.join(have, ["index_type", "date"], "left_anti").select(*COMPOSITION_COLUMNS)
    if store_path is not None:  # built once: the append and the result read the same copy
        spark = stored.sparkSession
        copy = scratch_path(spark, "built")
        fresh.write.parquet(copy)
        fresh = spark.read.schema(fresh.schema).parquet(copy)
        append_composition(fresh, store_path, run_ts)
    return snap.unionByName(fresh)


def performance_view(performance: DataFrame, start=None, end=None, index_type=None) -> DataFrame:
    """Serving shape: date as 'YYYY-MM-DD' text, index_price, daily_return, index_type."""
    hist = performance_history(performance, start, end, index_type)
    return hist.select(date_text("date").alias("date"), "index_price", "daily_return",
                       "index_type")


def composition_view(composition: DataFrame, date=None, index_type=None) -> DataFrame:
    """Serving shape: ticker, weight, market_cap, close_price (+ index_type, date)."""
    snap = composition_snapshot(composition, date, index_type)
    return snap.select("ticker", "weight", "market_cap", "close_price", "index_type", "date")
