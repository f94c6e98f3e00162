"""Exports, roster and text helpers."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from indexforge.constants import EQUAL_WEIGHTED
from indexforge.functions import scalar as fn
from indexforge.schemas import INDEX_PERFORMANCE
from indexforge.session import local_path
from indexforge.sinks import export as exp
from indexforge.sources import fixtures as fx
from indexforge.sources import landing


def test_export_round_trip_and_empty(spark, scratch):
    perf = fx.performance(spark, SF_SMALL)
    base = scratch("csv")
    path = exp.export_performance(perf, base, EQUAL_WEIGHTED, "2024-01-05", "2024-01-25")
    assert path.endswith("performance_equal_weighted_2024-01-05_2024-01-25.csv")
    back = exp.read_csv(spark, path, INDEX_PERFORMANCE)
    src = perf.filter((F.col("index_type") == EQUAL_WEIGHTED) & F.col("date").between("2024-01-05", "2024-01-25"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src.collect()))
    assert exp.export_performance(perf, base, EQUAL_WEIGHTED, "1990-01-01", "1990-01-02") == ""
    assert not os.path.exists(local_path(f"{base}/performance_equal_weighted_1990-01-01_1990-01-02.csv"))


def test_money_text(spark):
    df = spark.createDataFrame([(12.345,), (None,)], "x double")
    assert [r.t for r in df.select(fn.money_text("x").alias("t")).collect()] == ["$12.35", "$nan"]


def test_roster_limit_and_missing_batch(spark, scratch):
    path = scratch("roster")
    os.makedirs(local_path(path))
    page = {"results": [{"ticker": t, "market": m, "active": a} for t, m, a in [
        ("CCC", "stocks", True), ("AAA", "stocks", True), ("BBB", "crypto", True),
        ("DDD", "stocks", False), ("EEE", "stocks", True)]]}
    with open(os.path.join(local_path(path), "page-0.json"), "w") as f:
        f.write(json.dumps(page) + "\n")
    assert [r.ticker for r in landing.roster_scan(spark, path, limit=2).collect()] == ["AAA", "CCC"]
    stored = spark.createDataFrame([("AAA",)], "ticker string")
    roster = landing.roster_scan(spark, path, limit=None)
    assert [r.ticker for r in landing.missing_symbols(roster, stored, n=1).collect()] == ["CCC"]
    assert [r.ticker for r in landing.missing_symbols(roster, stored).collect()] == ["CCC", "EEE"]


def test_details_missing_objects_give_nulls(spark, scratch):
    path = scratch("details")
    os.makedirs(local_path(path))
    rows = [{"results": {"ticker": "A", "market_cap": 5.0, "list_date": "2020-01-02",
                         "address": {"city": "X"}, "branding": {"logo_url": "l"}}},
            {"results": {"ticker": "B"}}]
    with open(os.path.join(local_path(path), "d.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + "\n")
    got = {r.ticker: r for r in landing.read_detail_payloads(spark, path).collect()}
    assert got["A"].city == "X" and got["A"].branding_logo_url == "l" \
        and got["A"].list_date == dt.date(2020, 1, 2)
    assert got["B"].city is None and got["B"].branding_icon_url is None and got["B"].market_cap is None
