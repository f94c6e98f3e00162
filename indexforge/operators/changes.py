"""Membership per day and the days on which it changes.

Membership of a date is the ticker-sorted, comma-separated list of its latest
members.  The previous snapshot is taken with ``lag`` before the date filter is
applied, over a history that reaches back to the last date before the window, so the
first reported day can point to it.  A ``listagg`` group holds one date's
members, bounded by the index size of the runs, not by the bar volume.

Change reports build few of these lists.  Every day gets a fingerprint of its members that does not depend on
their order (their number, the sum and the XOR of two 64-bit hashes: a plain hash aggregate), and days whose
fingerprint equals the day before are out.  Members are sorted and joined for the other days and
their predecessors only, and the lists decide.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexforge.constants import MEMBERSHIP_SEPARATOR
from indexforge.operators.versions import restrict, latest_weights, version_collapse_legacy

CHANGE_COLUMNS = ["date", "symbols", "prev_date", "prev_symbols", "index_type"]


def daily_membership(members: DataFrame) -> DataFrame:
    """(index_type, date, symbols) with symbols sorted by ticker."""
    return (members.groupBy("index_type", "date")
            .agg(F.expr(f"listagg(ticker, '{MEMBERSHIP_SEPARATOR}') "
                        f"WITHIN GROUP (ORDER BY ticker)").alias("symbols")))


def membership_lag(daily: DataFrame) -> DataFrame:
    """Previous date and previous symbols per index (strict as-of, backwards)."""
    w = Window.partitionBy("index_type").orderBy("date")
    return (daily.withColumn("prev_date", F.lag("date").over(w))
            .withColumn("prev_symbols", F.lag("symbols").over(w)))


def changed(symbols="symbols", prev="prev_symbols") -> Column:
    """``symbols != prev_symbols OR prev_symbols IS NULL`` (three-valued logic)."""
    s = F.col(symbols) if isinstance(symbols, str) else symbols
    p = F.col(prev) if isinstance(prev, str) else prev
    return (s != p) | p.isNull()


def day_fingerprints(members: DataFrame) -> DataFrame:
    """(index_type, date, n, s, x): equal for days with the same members, however often and in whatever order."""
    return members.groupBy("index_type", "date").agg(
        F.count("ticker").alias("n"), F.sum(F.xxhash64("ticker").cast("decimal(20,0)")).alias("s"),
        F.bit_xor(F.xxhash64(F.lit(1), "ticker")).alias("x"))


def days_in_question(history: DataFrame, members_of: Callable[[DataFrame], DataFrame], start=None, end=None) -> DataFrame:
    """(index_type, date, prev_date) of the days in range whose members may differ from the day before: those
    without such a day, or behind one without members, or with another fingerprint."""
    w = Window.partitionBy("index_type").orderBy("date")
    days = day_fingerprints(members_of(history)).select(
        "index_type", "date", "n", F.struct("n", "s", "x").alias("f")).withColumns({
            "prev_date": F.lag("date").over(w), "_n": F.lag("n").over(w), "_f": F.lag("f").over(w)})
    other = F.coalesce(F.col("_n"), F.lit(0)).eqNullSafe(F.lit(0)) | ~F.col("f").eqNullSafe(F.col("_f"))
    # after the window, on purpose
    return restrict(days.filter(other).select("index_type", "date", "prev_date"), None, start=start, end=end)


def _report(history: DataFrame, members_of: Callable[[DataFrame], DataFrame], start, end) -> DataFrame:
    days = days_in_question(history, members_of, start, end)
    needed = days.select("index_type", "date").unionByName(
        days.select("index_type", F.col("prev_date").alias("date"))).filter("date IS NOT NULL").distinct()
    lists = daily_membership(members_of(history.join(needed, ["index_type", "date"], "left_semi")))
    before = lists.select("index_type", F.col("date").alias("prev_date"), F.col("symbols").alias("prev_symbols"))
    out = days.join(lists, ["index_type", "date"]).join(before, ["index_type", "prev_date"], "left")
    return out.filter(F.coalesce(changed(), F.lit(False))).select(*CHANGE_COLUMNS)


def _newest_members(composition: DataFrame) -> DataFrame:
    return latest_weights(composition).select("index_type", "date", "ticker")


def _legacy_members(composition: DataFrame) -> DataFrame:
    return version_collapse_legacy(composition).select("index_type", "date", "ticker")


def _reported_history(composition: DataFrame, start, end, index_type) -> DataFrame:
    """The dates a report can look at: none after ``end``, and before ``start`` only those
    from the last earlier date on (of the index type where that is earliest).  ``lag``
    looks back one date, so the rest cannot matter; both bounds reach the scan."""
    out = restrict(composition, index_type, end=end)
    if start is None:
        return out
    before = restrict(composition, index_type).filter(F.col("date") < F.lit(str(start)).cast("date"))
    last = before.groupBy("index_type").agg(F.max("date").alias("d"))
    floor = last.agg(F.coalesce(F.min("d"), F.lit(str(start)).cast("date")).alias("d")).scalar()
    return out.filter(F.col("date") >= floor)


def detect_index_changes(composition: DataFrame, start=None, end=None,
                         index_type=None) -> DataFrame:
    """(date, symbols, prev_date, prev_symbols, index_type) for change days in range."""
    return _report(_reported_history(composition, start, end, index_type), _newest_members, start, end)


def previous_snapshot_lookup(composition: DataFrame, index_type=None) -> DataFrame:
    """Every date with the latest earlier date and its symbols."""
    members = latest_weights(composition, index_type).select("index_type", "date", "ticker")
    return membership_lag(daily_membership(members)).select(*CHANGE_COLUMNS)


def change_event_count(changes: DataFrame) -> DataFrame:
    return changes.groupBy("index_type").agg(F.count(F.lit(1)).alias("change_days"))


def index_changes_legacy(composition: DataFrame, start=None, end=None,
                         index_type=None) -> DataFrame:
    """First-generation changes over the legacy collapse: a ticker with differing
    versions appears more than once in ``symbols``."""
    return _report(_reported_history(composition, start, end, index_type), _legacy_members, start, end)
