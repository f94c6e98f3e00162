"""Plan shape: the properties the design relies on at scale."""

from conftest import SF_SMALL
from indexforge.operators import construct as con
from indexforge.operators import performance as perf
from indexforge.plans.catalog import QUERIES
from indexforge.sources import fixtures as fx


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_is_cut_before_the_shuffle(spark):
    df = con.build_index(fx.bars(spark, SF_SMALL), fx.instruments(spark, SF_SMALL), 5)
    p = _plan(df)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_report_range_reaches_the_scan(spark):
    df = perf.track_index_performance(fx.bars(spark, SF_SMALL), fx.composition(spark, SF_SMALL),
                                      "2024-01-05", "2024-01-25")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-05" in p


def test_no_python_in_any_registered_plan(spark):
    for key, q in QUERIES.items():
        if key in ("ingest_stream",):
            continue
        p = _plan(q(spark, SF_SMALL))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                       "MapInPandas", "PythonUDF"):
            assert marker not in p, f"{key} uses {marker}"
