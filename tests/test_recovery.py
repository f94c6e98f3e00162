"""Jobs that are lost half-way: nothing is lost from the current table, nothing is loaded twice."""

import json
import os
import shutil

import pytest

from compare import rows
from indexforge.plans import ingest, load_log
from indexforge.plans.ingest import current_prices, ingest_daily, read_current, read_price_log
from indexforge.session import local_path
from indexforge.streaming.ingest_stream import run_ingest_stream

DAY = 86_400_000
T0 = 1704067200000  # 2024-01-01


def land(root, date, bars, name="x.json"):
    path = os.path.join(local_path(root), f"date={date}")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(json.dumps({"results": [{"T": t, "t": T0 + DAY * d, "c": c} for t, d, c in bars]}) + "\n")


def table(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


class Lost(Exception):
    pass


@pytest.fixture()
def job(spark, scratch):
    root = scratch("land")
    land(root, "2024-01-01", [("A", 0, 1.0), ("B", 0, 5.0), ("C", 1, 7.0)])
    land(root, "2024-01-02", [("A", 0, 2.0), ("A", 1, 3.0)])
    land(root, "2024-01-03", [("A", 0, 4.0), ("D", 2, 9.0)])
    paths = {"log": scratch("log"), "dead": scratch("dead"), "cur": scratch("cur")}

    def run(day, rule="partial", ts="2024-02-01 00:00:00"):
        return ingest_daily(spark, root, paths["log"], paths["dead"], dates=[f"2024-01-0{day}"], run_ts=ts,
                            load_id=f"l{day}", current_path=paths["cur"], rule=rule)
    run.paths = paths
    run.same = lambda rule="partial": (table(read_current(spark, paths["cur"])) ==
                                       table(current_prices(read_price_log(spark, paths["log"]), rule)))
    return run


@pytest.mark.parametrize("rule", ["partial", "replace"])
def test_killed_between_delete_and_rename(spark, job, monkeypatch, rule):
    job(1, rule)
    cur = job.paths["cur"]

    def half(spark_, staged, current):
        for x in os.listdir(local_path(current)):
            if x.startswith("key_date="):
                shutil.rmtree(os.path.join(local_path(current), x))
        raise Lost

    with monkeypatch.context() as m:
        m.setattr(ingest, "_swap", half)
        with pytest.raises(Lost):
            job(2, rule)
        # readers see the merged table all the same
        assert {(r.ticker, r.timestamp, r.close) for r in read_current(spark, cur).collect()} == {
            ("A", T0, 2.0), ("A", T0 + DAY, 3.0), ("B", T0, 5.0), ("C", T0 + DAY, 7.0)}
    job(3, rule)  # finishes the merge of l2 first
    assert job.same(rule) and len(table(read_current(spark, cur))) == 5
    assert not os.path.exists(local_path(f"{cur}_merge"))
    record = load_log.committed(spark, job.paths["log"], "l2")
    assert record["counts"] == {"total": 2, "success": 2, "rejected": 0} and record["seq"] == 2
    assert job(2, rule) == record["counts"]  # committed when it was finished: skipped
    assert load_log.committed(spark, job.paths["log"], "l2") == record and job.same(rule)


@pytest.mark.parametrize("rule", ["partial", "replace"])
@pytest.mark.parametrize("step", ["merge_into_current", "write_small"])
def test_retry_out_of_order_with_equal_run_timestamps(spark, job, monkeypatch, rule, step):
    job(1, rule)

    def lost(*args, **kw):
        raise Lost

    with monkeypatch.context() as m:
        m.setattr(ingest, step, lost)
        with pytest.raises(Lost):
            job(2, rule)
    # the open load is in neither
    assert job.same(rule) and len(table(read_current(spark, job.paths["cur"]))) == 3
    job(3, rule)
    assert job.same(rule)
    job(2, rule)  # after l3, under the same stamp
    assert job.same(rule)
    got = {(r.ticker, r.timestamp): r.close for r in read_current(spark, job.paths["cur"]).collect()}
    assert got[("A", T0)] == 2.0 and len(got) == 5
    assert load_log.committed(spark, job.paths["log"], "l2")["seq"] == 4


def test_replayed_batch_is_skipped_after_its_commit(spark, scratch):
    root, log, dead, cur, ckpt = (scratch(x) for x in ("land", "log", "dead", "cur", "ckpt"))
    kw = {"run_ts": "2024-02-01 00:00:00", "current_path": cur}
    land(root, "2024-01-01", [("A", 0, 1.0), ("B", 0, 5.0)])
    first = run_ingest_stream(spark, root, log, dead, ckpt, **kw)
    land(root, "2024-01-02", [("A", 0, 2.0), ("A", 1, 3.0)], "y.json")
    second = run_ingest_stream(spark, root, log, dead, ckpt, **kw)
    assert [x["total"] for x in first + second] == [2, 2]
    # the stream lost its own commit of the last batch: the engine runs the batch again
    commits = os.path.join(local_path(ckpt), "commits")
    for x in os.listdir(commits):
        if x.lstrip(".").startswith("1"):
            os.remove(os.path.join(commits, x))
    folder = next(x for x in os.listdir(local_path(log)) if x.endswith(f"{1:012d}"))
    before = sorted(os.listdir(os.path.join(local_path(log), folder)))
    assert run_ingest_stream(spark, root, log, dead, ckpt, **kw) == second
    assert sorted(os.listdir(os.path.join(local_path(log), folder))) == before
    assert len([x for x in os.listdir(os.path.join(local_path(log), "_commits")) if x.startswith("seq-")]) == 2
    assert table(read_current(spark, cur)) == table(current_prices(read_price_log(spark, log)))


def test_load_ids_and_sequences(spark, scratch, job):
    job(1)
    other = scratch("land")
    land(other, "2024-01-01", [("Z", 0, 1.0)])
    with pytest.raises(ValueError, match="another request"):
        ingest_daily(spark, other, job.paths["log"], job.paths["dead"], load_id="l1", run_ts="2024-02-01 00:00:00")
    log = scratch("log")
    assert [load_log.claim_sequence(spark, log, x) for x in "aba"] == [1, 2, 3]
    # days of one stamp without a load id are loads of their own
    root = scratch("land")
    land(root, "2024-01-01", [("A", 0, 1.0)])
    land(root, "2024-01-02", [("B", 1, 1.0)])
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        ingest_daily(spark, root, log, scratch("dead"), dates=[day], run_ts="2024-02-01 00:00:00")
    assert sorted(r.ticker for r in read_price_log(spark, log).collect()) == ["A", "B"]
