"""Nothing is lost without a trace: appends, loads of several streams, exports, profiles."""

import datetime as dt
import json
import math
import os
import random
import re
import struct

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from conftest import SF_SMALL
from indexforge.constants import EQUAL_WEIGHTED
from indexforge.operators import changes as chg
from indexforge.operators import construct as con
from indexforge.operators import exact
from indexforge.operators import performance as perf
from indexforge.operators import versions as ver
from indexforge.plans import views
from indexforge.plans.catalog import QUERIES
from indexforge.plans.ingest import (
    CURRENT_PRICES, _key_day_filter, ingest_daily, read_current, read_price_log, write_prices,
)
from indexforge.session import local_path
from indexforge.sinks import export as exp
from indexforge.schemas import INDEX_COMPOSITION, INDEX_COMPOSITION_KEY
from indexforge.sinks.versioned import RUN_DATE, _stored_keys, append_composition
from indexforge.sources import fixtures as fx
from indexforge.sources import landing
from indexforge.sources.tables import scan_table
from indexforge.streaming.ingest_stream import run_ingest_stream

D = dt.date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def write_lines(path, name, lines):
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), name), "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def test_append_accounts_for_every_row(spark, scratch):
    prices = spark.createDataFrame(
        [("A", 0, D(2024, 1, 1), 10.0), ("A", 1, D(2024, 1, 1), 12.0), ("B", 0, D(2024, 1, 1), 11.0)],
        "ticker string, timestamp bigint, date date, close double")
    inst = spark.createDataFrame([("A", 0.0), ("B", 0.0)], "ticker string, market_cap double")
    built = con.build_index(prices, inst, 5)
    path = scratch("comp")
    counts = append_composition(built, path, "2024-02-01 00:00:00")
    assert counts == {"built": 6, "written": 2, "conflicts": 0, "repeated": 1, "rejected": 3}
    lost = [json.loads(r.value) for r in spark.read.text(f"{path}_rejected/run=20240201000000/attempt=*").collect()]
    assert sorted(r["reason"] for r in lost) == ["null_value:weight"] * 3 + ["repeated_key"]
    again = append_composition(built, path, "2024-02-01 00:00:00")
    assert again == {"built": 6, "written": 0, "conflicts": 2, "repeated": 1, "rejected": 3}


def test_second_checkpoint_keeps_both_loads(spark, scratch):
    log, dead = scratch("log"), scratch("dead")
    for ticker in ("A", "B"):
        land = scratch("land")
        write_lines(f"{land}/date=2024-01-01", "x.json", [{"results": [{"T": ticker, "t": 1704067200000, "c": 1.0}]}])
        run_ingest_stream(spark, land, log, dead, scratch("ckpt"), run_ts="2024-03-01 00:00:00")
    assert {r.ticker for r in read_price_log(spark, log).collect()} == {"A", "B"}


def test_merge_reads_only_the_key_days_of_the_load(spark, scratch):
    land, log, dead, cur = scratch("land"), scratch("log"), scratch("dead"), scratch("cur")
    fx.land_bar_payloads(fx.ticks(spark, SF_SMALL), land)
    ingest_daily(spark, land, log, dead, run_ts="2024-03-01 00:00:00", load_id="a", current_path=cur)
    load = spark.read.parquet(f"{log}/load=a").filter("date = '2024-01-10'").withColumn(
        "key_date", F.to_date(F.timestamp_millis("timestamp")))
    p = plan(spark.read.schema(CURRENT_PRICES).parquet(cur).filter(_key_day_filter(load)))
    assert "PartitionFilters: [key_date" in p and "2024-01-10" in p and "2024-01-20" not in p
    staged = [x for x in os.listdir(local_path(os.path.dirname(cur))) if x.startswith(("prices_merge", "parsed", "append"))]
    assert not staged
    assert read_current(spark, cur).count() == read_price_log(spark, log).select("ticker", "timestamp").distinct().count()


def test_no_job_and_no_gathered_group_in_plans(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans are built without running anything")
    try:
        px, inst, comp = fx.bars(spark, SF_SMALL), fx.instruments(spark, SF_SMALL), fx.composition(spark, SF_SMALL)
        before = len(tracker.getJobIdsForGroup("plans"))
        plans = [plan(con.build_index(px, inst, 5)), plan(perf.track_index_performance(px, comp)),
                 plan(perf.index_level_legacy(px, comp)), plan(views.composition_get_or_build(comp, px, inst, 5)),
                 plan(QUERIES["composition_insights"](spark, SF_SMALL))]
        assert len(tracker.getJobIdsForGroup("plans")) - before <= 5  # schema reads of the small tables only
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not any("collect_list" in p for p in plans)
    assert not any("LocalLimit" in p for p in plans)


def test_change_report_bounds_reach_the_scan(spark, scratch):
    path = scratch("comp")
    for ts, run in fx.composition_runs(spark, SF_SMALL):
        append_composition(run, path, ts)
    comp = scan_table(spark, path, "index_composition")
    df = chg.detect_index_changes(comp, "2024-01-10", "2024-01-12")
    assert "LessThanOrEqual(date,2024-01-12)" in plan(df)
    whole = chg.detect_index_changes(comp).filter("date BETWEEN '2024-01-10' AND '2024-01-12'")
    assert sorted(map(str, df.collect())) == sorted(map(str, whole.collect()))


def test_runs_are_laid_out_by_date(spark, scratch):
    path = scratch("comp")
    append_composition(fx.composition_runs(spark, SF_SMALL)[0][1].repartition(8), path, "2024-02-01 00:00:00")
    comp = scan_table(spark, path, "index_composition")
    per_day = comp.select("date", F.input_file_name().alias("f")).distinct().groupBy("date").count()
    assert per_day.agg(F.max("count")).first()[0] <= 4  # two index types, a range may end inside a day


def test_levels_do_not_depend_on_the_layout(spark):
    px, comp = fx.bars(spark, SF_SMALL), ver.latest_weights(fx.composition(spark, SF_SMALL))
    one = {(r.index_type, r.date): r.index_price for r in perf.index_level(px, comp).collect()}
    other = perf.index_level(px.repartition(13, "close"), comp.repartition(5, "weight"))
    assert one == {(r.index_type, r.date): r.index_price for r in other.collect()}


def _sums(spark, groups):
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v double").repartition(5)
    return {r.k: r.s for r in exact.exact_sums(df, ["k"], F.col("v"), "s").collect()}


def test_exact_sums_round_once(spark):
    r, big = random.Random(7), 1.7976931348623157e308
    groups = {
        0: [9e21] * 20 + [1e-16] * 10, 1: [1e300, 1.0, -1e300], 2: [0.1] * 10, 3: [5e-324] * 3, 4: [-0.0, 0.0],
        5: [2.0 ** 53, 1.0, 2.0 ** -1074], 6: [2.0 ** 53, 1.0], 7: [-(2.0 ** 53), -1.0, -5e-324], 8: [big, -big, 2.5],
        9: [1e16, 1.0, -1e16, 1e-300], 10: [2.0 ** k for k in range(-1074, 1023)], 11: [-(2.0 ** k) for k in range(-60, 60)],
        **{k: [r.uniform(-1, 1) * 10.0 ** r.randint(-300, 300) for _ in range(50)] for k in range(20, 60)},
        **{k: [r.gauss(0, 1) * 2.0 ** r.randint(-30, 30) for _ in range(300)] for k in range(60, 90)},
        **{k: [2.0 ** (28 * j + d) * (1 + e * 2.0 ** -52) for j in range(-30, 30) for d in (-1, 0) for e in (0, 1)]
           for k, _ in [(90, 0)]}}
    assert _sums(spark, groups) == {k: math.fsum(v) for k, v in groups.items()}


def test_exact_sums_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    groups = {0: [nan, 1.0], 1: [inf, 1.0], 2: [inf, -inf], 3: [-inf, 1e300], 4: [None, None], 5: [None, 2.0],
              6: [1.7976931348623157e308] * 2}
    got = _sums(spark, groups)
    assert got[0] != got[0] and got[2] != got[2] and (got[1], got[3]) == (inf, -inf)
    assert got[4] is None and got[5] == 2.0 and got[6] == inf
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k int, v double")
    counts = exact.exact_sums(df, ["k"], F.col("v"), "s", "rows", "vals").collect()
    assert {r.k: (r.rows, r.vals) for r in counts} == {k: (len(v), sum(x is not None for x in v)) for k, v in groups.items()}
    assert exact.exact_sums(df.limit(0), ["k"], F.col("v"), "s").count() == 0


def test_levels_are_hash_aggregates(spark):
    px = spark.createDataFrame([("A", D(2024, 1, 1), 2.0)], "ticker string, date date, close double")
    w = spark.createDataFrame([("X", D(2024, 1, 1), "A", 0.5)], "index_type string, date date, ticker string, weight double")
    p = plan(perf.index_level(px, w))
    assert "HashAggregate" in p and not re.search("collect_list|SortAggregate|ObjectHashAggregate", p)


def test_csv_numbers_are_read_back_bit_for_bit(spark, scratch):
    r = random.Random(3)
    fixed = [7.95422e9, 1.5e-7, 0.25, 1e300, 1e-20, 1.5e21, 1.2345678901234567e-4, 5e-324, 1.7976931348623157e308, 0.0, -0.0,
             -1e-9, 1e7, 123456789.125, -2.5e15, 1e16, 0.001, 0.0009999]
    values = fixed + [struct.unpack("d", r.randbytes(8))[0] for _ in range(3000)]
    values = [v for v in values if math.isfinite(v)]
    df = spark.createDataFrame(list(enumerate(values)), "n int, x double").repartition(4)
    path = exp.export_query(df, scratch("csv"), "numbers")
    text = dict(x.value.split(",") for x in spark.read.text(path).collect() if not x.value.startswith("n"))
    assert not any(c in v for v in text.values() for c in "Ee")
    assert {int(k): float(v).hex() for k, v in text.items()} == {k: v.hex() for k, v in enumerate(values)}
    back = {x.n: x.x.hex() for x in exp.read_csv(spark, path, df.schema).collect()}
    assert back == {k: v.hex() for k, v in enumerate(values)}
    assert text["0"] == "7954220000.0" and text["5"] == "1500000000000000000000.0"
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,)], "x double")
    assert {x.v for x in odd.select(exp.plain_number(F.col("x")).alias("v")).collect()} == {"NaN", "Infinity", None}


def test_sorted_export_keeps_its_order_over_part_files(spark, scratch):
    df = spark.range(0, 4000, 1, 7).select((F.col("id") * 7919 % 4001).alias("k"), F.repeat(F.lit("x"), 50).alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = exp.export_query(df.orderBy("k"), scratch("csv"), "sorted")
        again = exp.export_query(df.filter("k < 5").orderBy("k"), os.path.dirname(path), "sorted")  # replaces it
        assert again == path
        path = exp.export_query(df.orderBy("k"), os.path.dirname(path), "sorted")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folder, seen = local_path(path), []
    parts = sorted(x for x in os.listdir(folder) if x.startswith("part-"))
    for x in parts:
        with open(os.path.join(folder, x)) as f:
            seen += [int(line.split(",")[0]) for line in f.read().splitlines()[1:]]
    assert len(parts) > 1 and seen == sorted(seen) and len(seen) == 4000
    assert [x for x in os.listdir(os.path.dirname(folder)) if x.startswith("sorted.csv.part")] == []


def test_both_strategies_of_one_stamp_keep_their_rejects(spark, scratch):
    path, ts = scratch("comp"), "2024-02-01 00:00:00"
    cols = "date date, ticker string, index_type string, weight double, market_cap double, close_price double"
    run = lambda t: spark.createDataFrame([(D(2024, 1, 1), "A", t, 0.5, 1.0, 2.0), (D(2024, 1, 1), "A", t, 0.6, 1.0, 2.0),
                                           (D(2024, 1, 1), "B", t, None, 1.0, 2.0)], cols)
    for t in ("Equal Weighted", "Market-Cap Weighted", "Equal Weighted"):  # the last is a retry
        append_composition(run(t), path, ts)
    lost = [json.loads(r.value) for r in spark.read.text(f"{path}_rejected/run=20240201000000/attempt=*").collect()]
    assert sorted((r["index_type"], r["reason"]) for r in lost) == sorted(
        (t, w) for t in ("Equal Weighted", "Market-Cap Weighted") for w in ("null_value:weight", "repeated_key"))


def test_a_retry_reads_its_own_runs_files_only(spark, scratch):
    path = scratch("comp")
    run = fx.composition_runs(spark, SF_SMALL)[0][1]
    for day in (1, 2, 3):
        append_composition(run, path, f"2024-02-0{day} 00:00:00")
    stored = spark.read.schema(StructType([*INDEX_COMPOSITION.fields, StructField(RUN_DATE, DateType())])).parquet(path)
    own = _stored_keys(stored, INDEX_COMPOSITION_KEY, "2024-02-02 00:00:00")
    p = plan(own)
    assert re.search(r"PartitionFilters: \[isnotnull\(run_date#\d+\), \(run_date#\d+ = 2024-02-02\)", p)
    files = own.select("*", F.input_file_name().alias("f")).select("f").distinct().collect()
    assert files and all("run_date=2024-02-02" in r.f for r in files)
    assert append_composition(run, path, "2024-02-02 00:00:00")["written"] == 0
    assert RUN_DATE not in scan_table(spark, path, "index_composition").columns


def test_explicit_null_flags_stay_null(spark, scratch):
    land = scratch("land")
    bar = {"T": "A", "t": 1704067200000, "c": 1.0}
    write_lines(f"{land}/date=2024-01-01", "x.json", [
        {"adjusted": None, "results": [dict(bar, otc=None)]}, {"results": [dict(bar, T="B")]},
        {"adjusted": True, "results": [dict(bar, T="C", otc=True)]}])
    got = {r.ticker: (r.is_otc, r.is_adjusted) for r in landing.read_bar_payloads(spark, land).collect()}
    assert got == {"A": (None, None), "B": (False, False), "C": (True, True)}


def test_profiles_that_do_not_fit_are_rejected(spark, scratch):
    path = scratch("details")
    write_lines(path, "x.json", [{"results": {"ticker": "A", "total_employees": 5}},
                                 {"results": {"ticker": "B", "total_employees": 99999999999}}, "{no json"])
    assert [r.ticker for r in landing.read_detail_payloads(spark, path).collect()] == ["A"]
    assert sorted(str(r.ticker) for r in landing.detail_rejects(spark, path).collect()) == ["B", "None"]


def test_sorts_are_in_order(spark):
    p = [(r.index_type, r.date) for r in QUERIES["sort_performance"](spark, SF_SMALL).collect()]
    assert p == sorted(p)
    c = [(r.index_type, r.date, -r.weight, r.ticker) for r in QUERIES["sort_composition"](spark, SF_SMALL).collect()]
    assert c == sorted(c)


def test_built_compositions_can_be_stored(spark, scratch):
    px, inst = fx.bars(spark, SF_SMALL), fx.instruments(spark, SF_SMALL)
    path = scratch("comp")
    comp = fx.composition(spark, SF_SMALL).filter("date <= '2024-01-15'")
    out = views.composition_get_or_build(comp, px, inst, 5, store_path=path, run_ts="2024-03-01 00:00:00")
    stored = scan_table(spark, path, "index_composition")
    assert stored.count() == out.filter("date > '2024-01-15'").count() > 0
    assert stored.filter(F.col("index_type") == EQUAL_WEIGHTED).count() * 2 == stored.count()


def test_prices_are_computed_once_and_a_hot_day_is_split(spark, scratch):
    rows = spark.range(0, 9000, 1, 4).select(
        F.concat(F.lit("T"), F.col("id") % 3000).alias("ticker"), F.col("id").alias("timestamp"),
        F.when(F.col("id") < 6000, F.lit("2024-01-05")).when(F.col("id") < 6010, None).otherwise(
            F.date_add(F.lit("2024-01-06"), (F.col("id") % 40).cast("int"))).cast("date").alias("date"),
        F.col("id").cast("double").alias("close"))
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    path = scratch("prices")
    write_prices(rows.mapInArrow(counted, rows.schema), path, num_files=12)
    assert runs.value == 9000
    out = spark.read.parquet(path)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    files = out.select("*", F.input_file_name().alias("f")).groupBy("f").agg(
        F.min("date").alias("a"), F.max("date").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    hot = [f for f in files if f.a <= D(2024, 1, 5) <= f.b]
    assert len(hot) >= 8 and max(f.n for f in files) < 1500
    assert all((f.b - f.a).days <= 15 for f in files)


def test_get_or_build_builds_once(spark, scratch):
    px, inst = fx.bars(spark, SF_SMALL), fx.instruments(spark, SF_SMALL)
    comp = fx.composition(spark, SF_SMALL).filter("date <= '2024-01-15'")
    out = views.composition_get_or_build(comp, px, inst, 5, store_path=scratch("comp"), run_ts="2024-03-01 00:00:00")
    assert any("/built-" in f for f in out.inputFiles())


def test_lists_are_built_for_changed_days_only(spark):
    """100 days with two real changes, re-ordered members, a rebuilt day and a day of null tickers."""
    rows = []
    for k in range(100):
        members = ["A", "B", "C"] if k < 40 else ["A", "B", "D"] if k < 70 else ["B", "D", "E", "F"]
        rows += [("X", D(2024, 1, 1) + dt.timedelta(days=k), t if k != 90 else None, dt.datetime(2024, 6, 1)) for t in members[::(-1) ** k]]
    rows += [("X", D(2024, 1, 6), "A", dt.datetime(2024, 6, 2))]
    comp = spark.createDataFrame([(*r, 1.0, 1.0, 1.0) for r in rows], "index_type string, date date, ticker string, "
                                 "update_time timestamp_ntz, weight double, market_cap double, close_price double").repartition(6)
    days = chg.days_in_question(comp, chg._newest_members).collect()
    first = D(2024, 1, 1)
    assert sorted((r.date - first).days for r in days) == [0, 40, 70, 90, 91]
    whole = chg.membership_lag(chg.daily_membership(chg._newest_members(comp)))
    want = whole.filter(F.coalesce(chg.changed(), F.lit(False))).select(*chg.CHANGE_COLUMNS)
    got = chg.detect_index_changes(comp)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 4
    lists = plan(got)
    assert re.search(r"listagg", lists) and lists.index("listagg") < lists.index("LeftSemi")
