"""Brute-force checks against pandas, the library the original computes with."""

import datetime as dt
import math
import warnings

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from indexforge.constants import EQUAL_WEIGHTED, MARKET_CAP_WEIGHTED
from indexforge.operators import construct as con
from indexforge.operators import performance as perf
from indexforge.sources import fixtures as fx

LEVEL = st.one_of(st.none(), st.just(0.0), st.floats(-50, 500, allow_nan=False).map(lambda x: round(x, 2)))
SERIES = st.lists(st.lists(LEVEL, min_size=1, max_size=12), min_size=1, max_size=25)


def _pandas_returns(values):
    s = pd.Series(values, dtype="float64")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        try:
            r = s.pct_change(fill_method="pad")
        except TypeError:
            r = s.pct_change()
    return list((r.fillna(0) * 100).astype(float))


def _same(a, b):
    if math.isinf(a) or math.isinf(b):
        return a == b
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(SERIES)
def test_daily_return_equals_pandas(spark, series):
    rows = [(f"s{i}", dt.date(2024, 1, 1) + dt.timedelta(days=j), v)
            for i, vals in enumerate(series) for j, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "index_type string, date date, index_price double")
    got = {}
    for r in perf.daily_return(df).collect():
        got.setdefault(r.index_type, []).append((r.date, r.daily_return))
    for i, vals in enumerate(series):
        ours = [v for _, v in sorted(got[f"s{i}"])]
        want = _pandas_returns(vals)
        assert all(_same(a, b) for a, b in zip(ours, want)), (vals, ours, want)


def test_build_equals_per_date_pandas_loop(spark):
    """The original builds one date at a time: join, cap not null, cap desc, head(n)."""
    bars = fx.bars(spark, SF_SMALL).toPandas()
    inst = fx.instruments(spark, SF_SMALL).toPandas()[["ticker", "market_cap"]]
    n = 5
    expect = {}
    for d, day in bars.groupby("date"):
        j = day.merge(inst, on="ticker")
        j = j[j.market_cap.notna()].sort_values(["market_cap", "ticker"], ascending=[False, True]).head(n)
        total = j.market_cap.sum()
        for t, cap in zip(j.ticker, j.market_cap):
            expect[(EQUAL_WEIGHTED, d, t)] = 1 / len(j)
            expect[(MARKET_CAP_WEIGHTED, d, t)] = cap / total
    got = {(r.index_type, r.date, r.ticker): r.weight
           for r in con.build_index(fx.bars(spark, SF_SMALL), fx.instruments(spark, SF_SMALL), n).collect()}
    assert set(got) == set(expect)
    assert all(math.isclose(got[k], expect[k], rel_tol=1e-12) for k in got)


def test_signed_zero_and_nan_follow_pandas(spark):
    vals = [-0.0, 1.0, float("nan"), 2.0, 0.0, -3.0]
    rows = [("s", dt.date(2024, 1, 1) + dt.timedelta(days=j), v) for j, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "index_type string, date date, index_price double")
    ours = [r.daily_return for r in perf.daily_return(df).orderBy("date").collect()]
    want = _pandas_returns(vals)
    assert all(_same(a, b) for a, b in zip(ours, want)), (ours, want)


def test_index_level_is_reproducible_across_layouts(spark):
    from indexforge.operators import versions as ver

    weights = ver.latest_weights(fx.composition(spark, SF_SMALL))
    bars = fx.bars(spark, SF_SMALL)
    a = {(r.index_type, r.date): r.index_price.hex()
         for r in perf.index_level(bars.repartition(3), weights).collect()}
    b = {(r.index_type, r.date): r.index_price.hex()
         for r in perf.index_level(bars.repartition(11, "ticker").sortWithinPartitions("close"),
                                   weights.repartition(5)).collect()}
    assert a == b
