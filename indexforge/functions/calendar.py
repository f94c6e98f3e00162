"""Date helpers as Catalyst expressions.

All of them are independent of the session time zone: bar dates are UTC dates
of epoch milliseconds, the floor of milliseconds / day.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexforge.constants import DEFAULT_WINDOW_DAYS, MS_PER_DAY

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_ms_to_date(ms) -> Column:
    """Epoch milliseconds -> UTC calendar date (floor division, so pre-1970 works)."""
    return F.date_from_unix_date(F.floor(_c(ms) / F.lit(MS_PER_DAY)).cast("int"))


def date_to_epoch_ms(d) -> Column:
    """UTC midnight of a date as epoch milliseconds."""
    return F.unix_date(_c(d)).cast("bigint") * F.lit(MS_PER_DAY)


def ntz_to_epoch_ms(ts) -> Column:
    """Epoch milliseconds of a wall-clock (TIMESTAMP_NTZ) value read as UTC; truncates."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), _c(ts))


def previous_trading_day(d) -> Column:
    """Saturday -> Friday, Sunday -> Friday, Monday -> Friday, otherwise the day before.

    No holiday calendar, as in the original scheduler.
    """
    dow = F.dayofweek(_c(d))  # 1 = Sunday ... 7 = Saturday
    back = F.when(dow == 2, 3).when(dow == 1, 2).otherwise(1)
    return F.date_sub(_c(d), back)


def weekday_only(d) -> Column:
    """True for Monday to Friday."""
    return F.dayofweek(_c(d)).between(2, 6)


def trading_calendar(bounds: DataFrame, start_col: str = "start",
                     end_col: str = "end") -> DataFrame:
    """Monday-Friday dates in [start, end] for every row of ``bounds``.

    A reversed range gives no rows (``sequence`` would otherwise count down).
    The result size is bounded by the number of days in the ranges.
    """
    s, e = F.col(start_col), F.col(end_col)
    days = F.when(s <= e, F.sequence(s, e)).otherwise(F.array().cast("array<date>"))
    return (bounds.select(F.explode(days).alias("date"))
            .filter(weekday_only("date")))


def date_text(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM-dd")


def parse_date_text(s) -> Column:
    return F.to_date(_c(s), "yyyy-MM-dd")


def default_window(as_of: _dt.date | str, start=None, end=None,
                   days: int = DEFAULT_WINDOW_DAYS) -> tuple[_dt.date, _dt.date]:
    """Resolve a missing start to as_of - 30 days and a missing end to as_of.

    The original reads the wall clock; here the caller passes ``as_of``.
    """
    as_of = _dt.date.fromisoformat(str(as_of))
    start = _dt.date.fromisoformat(str(start)) if start else as_of - _dt.timedelta(days=days)
    end = _dt.date.fromisoformat(str(end)) if end else as_of
    return start, end


def calendar_bounds(spark: SparkSession, start, end) -> DataFrame:
    """One-row frame holding a date range, for ``trading_calendar``."""
    return spark.range(1).select(F.lit(str(start)).cast("date").alias("start"),
                                 F.lit(str(end)).cast("date").alias("end"))
