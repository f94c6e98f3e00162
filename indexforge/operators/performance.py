"""Index level, daily return and performance history.

The level is the raw weighted price ``SUM(weight * close)`` per date -- no
divisor, so membership changes move it.  The daily return follows pandas
``pct_change().fillna(0) * 100`` in date order, reproduced with window
functions (rules in ``pct_change``).  Return windows are partitioned by
``index_type``: at that point there is one row per day, so a partition holds at
most the number of days in the range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexforge.operators.exact import exact_sums
from indexforge.operators.versions import (
    restrict, latest_performance, latest_weights, performance_collapse_legacy,
    version_collapse_legacy,
)

PERFORMANCE_COLUMNS = ["date", "index_price", "daily_return", "index_type"]


def pct_change(level: str, partition, order, fill_zero: bool = True) -> Column:
    """pandas ``pct_change()`` (pad fill) * 100 as a window expression.

    * NaN counts as missing, like in pandas; missing values are forward-filled
      first, and a leading missing value has no previous value;
    * no previous value, or 0 / 0                        -> 0 (null if not fill_zero);
    * previous 0 and current non-zero                    -> +/- infinity, sign by
      IEEE division (a previous -0.0 flips it);
    * otherwise ``(current / previous - 1) * 100`` (a NaN outcome counts as missing).
    """
    if isinstance(partition, str):
        partition = [partition]
    if isinstance(order, str):
        order = [order]
    w = Window.partitionBy(*partition).orderBy(*order)
    lv = F.when(F.isnan(F.col(level)), F.lit(None).cast("double")).otherwise(F.col(level))
    filled = F.last(lv, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # lag of the filled series = last non-missing value strictly before this row
    prev = F.last(lv, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    missing = F.lit(0.0) if fill_zero else F.lit(None).cast("double")
    negative_zero = prev.cast("string") == F.lit("-0.0")
    ratio = (filled / prev - F.lit(1.0)) * F.lit(100.0)
    return (F.when(prev.isNull() | filled.isNull(), missing)
            .when((prev == 0) & (filled == 0), missing)
            .when((prev == 0) & ((filled > 0) != negative_zero), F.lit(float("inf")))
            .when(prev == 0, F.lit(float("-inf")))
            .when(F.isnan(ratio), missing)
            .otherwise(ratio))


def index_level(prices: DataFrame, weights: DataFrame) -> DataFrame:
    """``SUM(weight * close)`` per (index_type, date) over bars joined to weights
    on (ticker, date).  A missing bar drops the name (inner join, no re-weighting).

    The weights side holds index members x days (x index types), independent of the bar
    volume; Spark broadcasts it by size, or shuffles both sides on (ticker, date).
    The sum is exact up to one rounding, so it does not depend on the layout: reruns
    are collapsed by comparing ``index_price`` (first-generation history).
    """
    px = prices.select("ticker", "date", "close")
    w = weights.select("index_type", "date", "ticker", "weight")
    return exact_sums(px.join(w, ["ticker", "date"]), ["index_type", "date"],
                      F.col("weight") * F.col("close"), "index_price")


def daily_return(levels: DataFrame, fill_zero: bool = True,
                 order=("date",)) -> DataFrame:
    return levels.withColumn(
        "daily_return", pct_change("index_price", "index_type", list(order), fill_zero))


def track_index_performance(prices: DataFrame, composition: DataFrame, start=None,
                            end=None, index_type=None) -> DataFrame:
    """(date, index_price, daily_return, index_type) for every date of the range.

    Dates are filtered *before* the return, so the first day of the requested
    window has return 0.  The date filter on the bars is inferred onto the
    composition side of the (ticker, date) join and reaches both scans.
    """
    weights = latest_weights(composition, index_type, start, end)
    bars = restrict(prices, None, start=start, end=end)
    return daily_return(index_level(bars, weights)).select(*PERFORMANCE_COLUMNS)


def performance_history(performance: DataFrame, start=None, end=None,
                        index_type=None) -> DataFrame:
    """Stored history: newest version per date in the range, return recomputed
    over the window (first row 0)."""
    latest = latest_performance(performance, start, end, index_type)
    return (daily_return(latest.select("index_type", "date", "index_price"))
            .select(*PERFORMANCE_COLUMNS).orderBy("index_type", "date"))


def return_summary(performance: DataFrame) -> DataFrame:
    """Total (plain sum, not compounded), mean and sample std of daily returns.
    A single day has a null standard deviation."""
    return (performance.groupBy("index_type")
            .agg(F.sum("daily_return").alias("total_return"),
                 F.avg("daily_return").alias("mean_return"),
                 F.stddev_samp("daily_return").alias("volatility"),
                 F.count(F.lit(1)).alias("days")))


def index_level_legacy(prices: DataFrame, composition: DataFrame, start=None,
                       end=None, index_type=None) -> DataFrame:
    """First-generation performance: level over the legacy collapse (rows that
    differ between runs are all summed), return as in ``track_index_performance``."""
    weights = version_collapse_legacy(restrict(composition, index_type, start=start, end=end))
    bars = restrict(prices, None, start=start, end=end)
    return daily_return(index_level(bars, weights)).select(*PERFORMANCE_COLUMNS)


def performance_history_legacy(performance: DataFrame, start=None, end=None,
                               index_type=None) -> DataFrame:
    """First-generation history: legacy collapse for the range, return recomputed
    in (date, index_price) order with the first row left null."""
    collapsed = performance_collapse_legacy(restrict(performance, index_type, start=start, end=end))
    return (daily_return(collapsed, fill_zero=False, order=("date", "index_price"))
            .select("date", "index_price", "daily_return", "latest_update_time", "index_type"))
