"""Literal-row tests of the rules that are easy to get wrong."""

import datetime as dt
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from indexforge.constants import EQUAL_WEIGHTED, MARKET_CAP_WEIGHTED
from indexforge.functions import calendar as cal
from indexforge.functions import scalar as fn
from indexforge.operators import changes as chg
from indexforge.operators import construct as con
from indexforge.operators import performance as perf
from indexforge.operators import versions as ver
from indexforge.operators.audit import audit_table
from indexforge.operators.upsert import upsert_partial, upsert_replace
from indexforge.plans.ingest import current_prices, ingest_daily, read_price_log
from indexforge.session import local_path
from indexforge.sinks.dead_letters import read_dead_letters

D = dt.date


def _levels(spark, values):
    rows = [("X", D(2024, 1, i + 1), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "index_type string, date date, index_price double")


def _returns(df):
    return [r.daily_return for r in perf.daily_return(df).orderBy("date").collect()]


def test_pct_change_rules(spark):
    got = _returns(_levels(spark, [10.0, None, 12.0, 0.0, 5.0, None]))
    assert got == pytest.approx([0.0, 0.0, 20.0, -100.0, math.inf, 0.0])
    assert _returns(_levels(spark, [0.0, 0.0, -1.0])) == [0.0, 0.0, -math.inf]


def test_legacy_return_keeps_first_null(spark):
    df = _levels(spark, [10.0, 11.0])
    out = [r.daily_return for r in perf.daily_return(df, fill_zero=False).orderBy("date").collect()]
    assert out[0] is None and abs(out[1] - 10.0) < 1e-9


def test_one_row_std_is_null(spark):
    df = _levels(spark, [10.0]).withColumn("daily_return", F.lit(0.0))
    r = perf.return_summary(df).collect()[0]
    assert r.volatility is None and r.total_return == 0.0


def test_previous_trading_day(spark):
    days = [D(2023, 1, 2) + dt.timedelta(days=i) for i in range(7)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    got = [r.p for r in df.select(cal.previous_trading_day("date").alias("p")).collect()]
    assert got == [D(2022, 12, 30), D(2023, 1, 2), D(2023, 1, 3), D(2023, 1, 4),
                   D(2023, 1, 5), D(2023, 1, 6), D(2023, 1, 6)]


def test_epoch_ms_to_utc_date(spark):
    df = spark.createDataFrame([(1672531199999,), (1672531200000,), (-1,)], "t bigint")
    got = [r.d for r in df.select(cal.epoch_ms_to_date("t").alias("d")).collect()]
    assert got == [D(2022, 12, 31), D(2023, 1, 1), D(1969, 12, 31)]
    back = df.select(cal.date_to_epoch_ms(cal.epoch_ms_to_date("t")).alias("m")).collect()
    assert back[1].m == 1672531200000


def test_trading_calendar(spark):
    rev = cal.calendar_bounds(spark, "2023-01-08", "2023-01-01")
    assert cal.trading_calendar(rev).count() == 0
    week = cal.calendar_bounds(spark, "2023-01-01", "2023-01-08")
    assert [r.date for r in cal.trading_calendar(week).collect()] == \
        [D(2023, 1, d) for d in range(2, 7)]


def test_default_window():
    assert cal.default_window("2024-01-31") == (D(2024, 1, 1), D(2024, 1, 31))
    assert cal.default_window("2024-01-31", start="2024-01-10") == (D(2024, 1, 10), D(2024, 1, 31))


def test_text_helpers(spark):
    df = spark.createDataFrame([("Equal Weighted", 1.234, None)], "t string, x double, y double")
    r = df.select(fn.slug("t").alias("s"), fn.percent_text("x").alias("p"),
                  fn.percent_text("y").alias("q")).collect()[0]
    assert (r.s, r.p, r.q) == ("equal_weighted", "1.23%", "nan%")


def _comp(spark, rows):
    return spark.createDataFrame(
        rows, "date date, ticker string, close_price double, weight double, market_cap double, "
              "index_type string, update_time timestamp_ntz")


def test_window_edges_changes_vs_performance(spark):
    ts = dt.datetime(2024, 2, 1)
    comp = _comp(spark, [
        (D(2024, 1, 1), "A", 10.0, 1.0, 1.0, EQUAL_WEIGHTED, ts),
        (D(2024, 1, 2), "B", 20.0, 1.0, 1.0, EQUAL_WEIGHTED, ts)])
    prices = spark.createDataFrame(
        [("A", D(2024, 1, 1), 10.0), ("B", D(2024, 1, 2), 20.0)], "ticker string, date date, close double")
    ch = chg.detect_index_changes(comp, "2024-01-02", "2024-01-02").collect()
    assert len(ch) == 1 and ch[0].prev_date == D(2024, 1, 1) and ch[0].prev_symbols == "A"
    pf = perf.track_index_performance(prices, comp, "2024-01-02", "2024-01-02").collect()
    assert len(pf) == 1 and pf[0].daily_return == 0.0 and pf[0].index_price == 20.0


def test_latest_version_is_per_ticker(spark):
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    d = D(2024, 1, 2)
    comp = _comp(spark, [(d, t, 1.0, 0.2, 1.0, EQUAL_WEIGHTED, t1) for t in "ABCDE"]
                 + [(d, t, 1.0, 1 / 3, 1.0, EQUAL_WEIGHTED, t2) for t in "ABC"])
    snap = ver.composition_snapshot(comp).collect()
    assert sorted(r.ticker for r in snap) == list("ABCDE")
    assert sum(r.weight for r in snap) > 1.0
    legacy = ver.version_collapse_legacy(comp).count()
    assert legacy == 8  # differing versions are all kept


def test_weights_top_n_and_ties(spark):
    prices = spark.createDataFrame(
        [(t, 0, D(2024, 1, 1), 10.0) for t in "ABCDE"] + [("F", 0, D(2024, 1, 1), 10.0)],
        "ticker string, timestamp bigint, date date, close double")
    inst = spark.createDataFrame(
        [("A", 5.0), ("B", 4.0), ("C", 4.0), ("D", 1.0), ("E", None), ("F", 0.5)],
        "ticker string, market_cap double")
    out = con.build_index(prices, inst, 2).collect()
    ew = sorted((r.ticker, r.weight) for r in out if r.index_type == EQUAL_WEIGHTED)
    mcw = sorted((r.ticker, r.weight) for r in out if r.index_type == MARKET_CAP_WEIGHTED)
    assert ew == [("A", 0.5), ("B", 0.5)]  # B beats C on the ticker tie-break
    assert abs(sum(w for _, w in mcw) - 1.0) < 1e-12 and mcw[0] == ("A", 5.0 / 9.0)
    few = con.build_index(prices, inst, 100).filter(F.col("index_type") == EQUAL_WEIGHTED).collect()
    assert len(few) == 5 and all(abs(r.weight - 0.2) < 1e-12 for r in few)  # E is not eligible


def test_two_bars_one_day_multiply_and_audit_reports(spark):
    prices = spark.createDataFrame(
        [("A", 0, D(2024, 1, 1), 10.0), ("A", 1, D(2024, 1, 1), 11.0)],
        "ticker string, timestamp bigint, date date, close double")
    inst = spark.createDataFrame([("A", 5.0)], "ticker string, market_cap double")
    assert con.join_instruments_prices(prices, inst).count() == 2
    dup = prices.withColumn("timestamp", F.lit(0).cast("bigint"))
    rep = {(r.rule, r.column_name): r.violations
           for r in audit_table("stock_prices", dup, not_null=[]).collect()}
    assert rep[("duplicate_key", "ticker,timestamp")] == 1


def test_upsert_rules(spark):
    log = spark.createDataFrame(
        [("A", 1, D(2024, 1, 1), 10.0, 1), ("A", 1, D(2024, 1, 2), None, 2)],
        "ticker string, timestamp bigint, date date, close double, seq int")
    rep = upsert_replace(log, ["ticker", "timestamp"], "seq").collect()[0]
    par = upsert_partial(log, ["ticker", "timestamp"], "seq", ["date"], ["close"]).collect()[0]
    assert rep.date == D(2024, 1, 2) and rep.close is None
    assert par.date == D(2024, 1, 1) and par.close is None  # incoming null overwrites


def _land(root, day, lines):
    d = os.path.join(local_path(root), f"date={day}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.json"), "a") as f:
        for line in lines:
            f.write(line + "\n")


def test_ingest_dead_letters(spark, scratch):
    land, log, dead = scratch("land"), scratch("log"), scratch("dead")
    doc = {"adjusted": True, "results": [
        {"T": "A", "t": 1704067200000, "o": 1.0, "h": 2.0, "l": 0.5, "c": 1.5, "v": 10.0,
         "n": 3, "vw": 1.2},
        {"T": None, "t": 1704067200001, "c": 1.0},
        {"T": "B", "c": 1.0},
        {"T": "C", "t": 1704067200002, "n": 99999999999},
    ]}
    _land(land, "2024-01-01", [json.dumps(doc), "{not json"])
    counts = ingest_daily(spark, land, log, dead, run_ts="2024-01-02 00:00:00", load_id="l1")
    assert counts == {"total": 5, "success": 1, "rejected": 4}
    reasons = sorted(r.reason for r in read_dead_letters(spark, dead).collect())
    assert reasons == ["bad_value:n", "corrupt_record", "null_ticker", "null_timestamp"]
    cur = current_prices(read_price_log(spark, log)).collect()
    assert len(cur) == 1 and cur[0].ticker == "A" and cur[0].is_otc is False \
        and cur[0].is_adjusted is True and cur[0].date == D(2024, 1, 1)


def test_ingest_request_date_kept_on_partial_upsert(spark, scratch):
    land, log, dead = scratch("land"), scratch("log"), scratch("dead")
    bar = {"T": "A", "t": 1704067200000, "c": 1.0}
    _land(land, "2024-01-01", [json.dumps({"results": [bar]})])
    ingest_daily(spark, land, log, dead, dates=["2024-01-01"], run_ts="2024-01-02 00:00:00",
                 load_id="l1")
    _land(land, "2024-01-03", [json.dumps({"results": [dict(bar, c=2.0)]})])
    ingest_daily(spark, land, log, dead, dates=["2024-01-03"], run_ts="2024-01-04 00:00:00",
                 load_id="l2")
    part = current_prices(read_price_log(spark, log), "partial").collect()[0]
    rep = current_prices(read_price_log(spark, log), "replace").collect()[0]
    assert (part.date, part.close) == (D(2024, 1, 1), 2.0)
    assert (rep.date, rep.close) == (D(2024, 1, 3), 2.0)


def test_merge_into_current_touches_only_load_days(spark, scratch):
    from indexforge.plans.ingest import merge_into_current, read_current

    land, log, dead, cur = scratch("land"), scratch("log"), scratch("dead"), scratch("cur")
    day1 = {"results": [{"T": "A", "t": 1704067200000, "c": 1.0},
                        {"T": "B", "t": 1704067200000, "c": 5.0}]}
    _land(land, "2024-01-01", [json.dumps(day1)])
    ingest_daily(spark, land, log, dead, dates=["2024-01-01"], run_ts="2024-01-02 00:00:00",
                 load_id="l1", current_path=cur)
    # a later load re-delivers A (requested as another day) and adds a new day
    day2 = {"results": [{"T": "A", "t": 1704067200000, "c": 2.0},
                        {"T": "A", "t": 1704153600000, "c": 3.0}]}
    _land(land, "2024-01-02", [json.dumps(day2)])
    ingest_daily(spark, land, log, dead, dates=["2024-01-02"], run_ts="2024-01-03 00:00:00",
                 load_id="l2", current_path=cur)
    got = sorted((r.ticker, r.timestamp, r.date, r.close) for r in read_current(spark, cur).collect())
    assert got == [("A", 1704067200000, D(2024, 1, 1), 2.0),   # first date kept, price updated
                   ("A", 1704153600000, D(2024, 1, 2), 3.0),
                   ("B", 1704067200000, D(2024, 1, 1), 5.0)]
    # the merge result equals the view over the whole log
    view = sorted((r.ticker, r.timestamp, r.date, r.close)
                  for r in current_prices(read_price_log(spark, log)).collect())
    assert view == got
    # repeating a load changes nothing
    merge_into_current(spark, cur, spark.read.parquet(f"{log}/load=l2"))
    again = sorted((r.ticker, r.timestamp, r.date, r.close) for r in read_current(spark, cur).collect())
    assert again == got


def test_previous_trading_day_scalar():
    from indexforge.plans.ingest import previous_trading_day_of

    assert [previous_trading_day_of(D(2023, 1, 2) + dt.timedelta(days=i)) for i in range(7)] == \
        [D(2022, 12, 30), D(2023, 1, 2), D(2023, 1, 3), D(2023, 1, 4), D(2023, 1, 5),
         D(2023, 1, 6), D(2023, 1, 6)]


def test_zero_cap_total_weight_is_rejected_on_append(spark, scratch):
    from indexforge.sinks.versioned import append_composition
    from indexforge.sources.tables import scan_table

    prices = spark.createDataFrame([("A", 0, D(2024, 1, 1), 10.0), ("B", 0, D(2024, 1, 1), 11.0)],
                                   "ticker string, timestamp bigint, date date, close double")
    inst = spark.createDataFrame([("A", 0.0), ("B", 0.0)], "ticker string, market_cap double")
    built = con.build_index(prices, inst, 5)
    path, dead = scratch("comp"), scratch("dead")
    counts = append_composition(built, path, "2024-02-01 00:00:00", dead_path=dead)
    assert counts == {"built": 4, "written": 2, "conflicts": 0, "repeated": 0, "rejected": 2}
    lost = [json.loads(r.value) for r in spark.read.text(dead).collect()]
    assert all(r["index_type"] == MARKET_CAP_WEIGHTED and r["reason"] == "null_value:weight" for r in lost)
    stored = scan_table(spark, path, "index_composition")
    assert stored.count() == 2 and {r.index_type for r in stored.collect()} == {EQUAL_WEIGHTED}
    assert spark.read.text(dead).count() == 2


def test_reappending_a_run_adds_nothing(spark, scratch):
    from indexforge.sinks.versioned import append_composition, append_performance
    from indexforge.sources.tables import scan_table

    prices = spark.createDataFrame([("A", 0, D(2024, 1, 1), 10.0), ("B", 0, D(2024, 1, 1), 11.0)],
                                   "ticker string, timestamp bigint, date date, close double")
    inst = spark.createDataFrame([("A", 2.0), ("B", 1.0)], "ticker string, market_cap double")
    built = con.build_index(prices, inst, 5)
    path = scratch("comp")
    for _ in range(2):
        append_composition(built, path, "2024-02-01 00:00:00")
    assert scan_table(spark, path, "index_composition").count() == 4
    append_composition(built, path, "2024-02-02 00:00:00")
    assert scan_table(spark, path, "index_composition").count() == 8
    perf_rows = perf.track_index_performance(prices, scan_table(spark, path, "index_composition"))
    ppath = scratch("perf")
    for _ in range(2):
        append_performance(perf_rows, ppath, "2024-02-03 00:00:00")
    assert scan_table(spark, ppath, "index_performance").count() == 2


def test_dates_do_not_depend_on_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        df = spark.createDataFrame([(1672531199999,)], "t bigint").select(
            cal.epoch_ms_to_date("t").alias("d"),
            cal.date_to_epoch_ms(cal.epoch_ms_to_date("t")).alias("m"),
            cal.ntz_to_epoch_ms(F.lit("2023-01-01 00:00:00.5").cast("timestamp_ntz")).alias("n"))
        r = df.collect()[0]
        assert (r.d, r.m, r.n) == (D(2022, 12, 31), 1672444800000, 1672531200500)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_conflict_skip_keeps_a_deterministic_row(spark):
    from indexforge.sinks.versioned import conflict_skip, stamp

    rows = _comp(spark, [(D(2024, 1, 1), "A", 11.0, 0.5, 1.0, EQUAL_WEIGHTED, None),
                         (D(2024, 1, 1), "A", 10.0, 0.5, 1.0, EQUAL_WEIGHTED, None)]).drop("update_time")
    out = conflict_skip(stamp(rows, "2024-02-01 00:00:00"), None).collect()
    assert len(out) == 1 and out[0].close_price == 10.0
