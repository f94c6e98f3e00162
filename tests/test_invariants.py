"""Sanity invariants on the derived fixtures."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from indexforge.constants import EQUAL_WEIGHTED
from indexforge.operators import construct as con
from indexforge.operators import performance as perf
from indexforge.operators import versions as ver
from indexforge.sources import fixtures as fx


def test_weights_of_one_run_sum_to_one(spark):
    comp = fx.composition(spark, SF_SMALL)
    sums = (comp.groupBy("update_time", "index_type", "date")
            .agg(F.sum("weight").alias("s"), F.countDistinct("weight").alias("k"),
                 F.count(F.lit(1)).alias("n")))
    bad = sums.filter(F.abs(F.col("s") - 1.0) > 1e-9).count()
    assert bad == 0
    ew = sums.filter(F.col("index_type") == EQUAL_WEIGHTED)
    assert ew.filter(F.col("k") != 1).count() == 0  # equal weights are equal


def test_latest_weights_sum_above_one_on_rebuilt_days(spark):
    """Names that only an older run holds keep their weight, so a rebuilt day's weights exceed 1 where the newest
    run of the day is narrower than an earlier one; the runs themselves say on which days that is."""
    comp = fx.composition(spark, SF_SMALL)
    snap = ver.composition_snapshot(comp)
    over = (snap.groupBy("index_type", "date").agg(F.sum("weight").alias("s"))
            .filter(F.col("s") > 1.0 + 1e-9))
    got = {r.date for r in over.filter(F.col("index_type") == EQUAL_WEIGHTED).collect()}
    runs = {}
    for r in comp.filter(F.col("index_type") == EQUAL_WEIGHTED).select("date", "update_time", "ticker").collect():
        runs.setdefault(r.date, {}).setdefault(r.update_time, set()).add(r.ticker)
    want = {d for d, by in runs.items() if set().union(*by.values()) - by[max(by)]}
    assert got == want and 0 < len(want) < len(runs)


def test_level_positive_and_membership_counts(spark):
    lv = perf.index_level(fx.bars(spark, SF_SMALL), ver.latest_weights(fx.composition(spark, SF_SMALL)))
    assert lv.filter(F.col("index_price") <= 0).count() == 0
    run1 = con.build_index(fx.bars(spark, SF_SMALL), fx.instruments(spark, SF_SMALL), fx.RUN1_TOP_N)
    counts = con.constituent_count(run1).agg(F.max("constituents")).first()[0]
    assert counts == fx.RUN1_TOP_N
