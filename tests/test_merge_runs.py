"""A merge rewrites no more than it brings: many small loads to a large day do not rewrite it each time."""

import os

import pytest

from compare import rows
from conftest import SF_SMALL
from indexforge.plans import ingest
from indexforge.plans.ingest import current_prices, ingest_daily, read_current, read_price_log
from indexforge.session import local_path
from indexforge.sources import fixtures as fx
from indexforge.streaming.ingest_stream import run_ingest_stream
from test_recovery import Lost, land

DAY0 = [(f"T{i}", 0, float(i)) for i in range(40)]


def table(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture()
def job(spark, scratch, monkeypatch):
    """Loads of bars into one table that has runs whatever its size; counts the swaps of partitions."""
    monkeypatch.setattr(ingest, "SMALL_ROWS", 0)
    log, dead, cur = scratch("log"), scratch("dead"), scratch("cur")
    roots, swaps, swap = {}, [], ingest._swap

    def counted(spark_, staged, current):
        swaps.append(staged)
        swap(spark_, staged, current)
    monkeypatch.setattr(ingest, "_swap", counted)

    def run(name, bars, rule="partial", date="2024-01-01"):
        if name not in roots:
            roots[name] = scratch("land")
            land(roots[name], date, bars)
        return ingest_daily(spark, roots[name], log, dead, run_ts="2024-02-01 00:00:00", load_id=name,
                            current_path=cur, rule=rule)
    run.cur, run.swaps = cur, swaps
    run.runs = lambda: [r["n"] for r in ingest._listed(spark, cur)["runs"]]
    run.same = lambda rule="partial": (table(read_current(spark, cur)) ==
                                       table(current_prices(read_price_log(spark, log), rule)))
    return run


@pytest.mark.parametrize("rule", ["partial", "replace"])
def test_small_loads_do_not_rewrite_a_large_day(spark, job, rule):
    job("big", DAY0, rule)
    for i in range(3):
        job(f"s{i}", [("T1", 0, 100.0 + i), (f"N{i}", 0, 1.0)], rule, date=f"2024-01-0{i + 2}")
    assert len(job.swaps) == 1 and job.runs() == [4, 2] and job.same(rule)
    job("more", [(f"M{i}", i % 2, 2.0) for i in range(40)] + [("T1", 0, 7.0)], rule, date="2024-01-09")
    assert len(job.swaps) == 2 and job.runs() == [] and job.same(rule)
    assert not os.path.exists(local_path(f"{job.cur}_merge")) and os.listdir(local_path(f"{job.cur}_runs")) == []


def test_runs_of_another_rule_go_first(spark, job):
    job("big", DAY0)
    job("a", [("T1", 0, 100.0), ("X", 0, 5.0)], date="2024-01-02")
    assert job.runs() == [2]
    job("b", [("T1", 0, 200.0)], "replace", date="2024-01-03")
    got = {r.ticker: (str(r.date), r.close) for r in read_current(spark, job.cur).collect()}
    assert got["T1"] == ("2024-01-03", 200.0) and got["X"] == ("2024-01-02", 5.0) and len(got) == 41
    assert len(job.swaps) == 2 and job.runs() == [1]


@pytest.mark.parametrize("step", ["ready", "list"])
def test_run_that_is_lost_half_way(spark, job, monkeypatch, step):
    job("big", DAY0)
    real = ingest.write_small

    def lost(spark_, path, text, overwrite=True):
        if path.endswith(f"/{step}"):
            raise Lost
        return real(spark_, path, text, overwrite)

    with monkeypatch.context() as m:
        m.setattr(ingest, "write_small", lost)
        with pytest.raises(Lost):
            job("a", [("T1", 0, 100.0), ("X", 0, 5.0)], date="2024-01-02")
    # before the marker the load is in neither; after it, readers see the run
    assert len(table(read_current(spark, job.cur))) == (40 if step == "ready" else 41)
    job("b", [("T2", 0, 300.0)], date="2024-01-03")
    assert job.same() and len(table(read_current(spark, job.cur))) == (40 if step == "ready" else 41)
    job("a", [("T1", 0, 100.0), ("X", 0, 5.0)], date="2024-01-02")
    assert job.same() and len(table(read_current(spark, job.cur))) == 41


def test_days_beyond_the_list(spark, job, monkeypatch):
    monkeypatch.setattr(ingest, "MAX_LISTED_DAYS", 2)
    job("big", [(f"T{i}", i % 5, float(i)) for i in range(40)])
    job("a", [("T0", 0, 9.0), ("T1", 1, 9.0), ("T3", 3, 9.0)], date="2024-01-02")
    job("b", [("T4", 4, 9.0)], date="2024-01-03")
    assert job.runs() == [3, 1] and job.same()


def test_stream_of_one_file_batches_equals_the_log(spark, scratch, monkeypatch):
    monkeypatch.setattr(ingest, "SMALL_ROWS", 0)
    root, log, dead, cur, ckpt = (scratch(x) for x in ("land", "log", "dead", "cur", "ckpt"))
    land(root, "2024-01-01", DAY0, "big.json")
    kw = {"run_ts": "2024-02-01 00:00:00", "current_path": cur, "max_files_per_trigger": 1}
    run_ingest_stream(spark, root, log, dead, ckpt, **kw)
    for i in range(3):
        land(root, "2024-01-02", [("T1", 0, 100.0 + i), (f"N{i}", 1, 1.0)], f"s{i}.json")
    assert len(run_ingest_stream(spark, root, log, dead, ckpt, **kw)) == 3
    assert table(read_current(spark, cur)) == table(current_prices(read_price_log(spark, log)))


def test_landed_files_follow_the_days_not_the_tasks(spark, scratch):
    root, was = scratch("land"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fx.land_bar_payloads(fx.ticks(spark, SF_SMALL), root, chunk_rows=5)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    days = [d for d in os.listdir(local_path(root)) if d.startswith("date=")]
    files = [f for d in days for f in os.listdir(os.path.join(local_path(root), d)) if f.startswith("part-")]
    assert len(days) > 25 and len(files) == len(days)
    assert spark.read.text(root).count() == fx.ticks(spark, SF_SMALL).selectExpr("date", "floor(event_id / 5)").distinct().count()
