"""The README's daily flow, end to end on landed sf0.001 data."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from indexforge.operators import changes, construct, performance, versions
from indexforge.plans.ingest import ingest_daily, read_current
from indexforge.sinks.export import export_performance
from indexforge.sinks.versioned import append_composition, append_performance
from indexforge.sources import fixtures as fx
from indexforge.sources.landing import read_detail_payloads
from indexforge.sources.tables import scan_table


def test_daily_flow(spark, scratch):
    land, log, dead, cur = scratch("land"), scratch("log"), scratch("dead"), scratch("cur")
    fx.land_bar_payloads(fx.ticks(spark, SF_SMALL), land)
    details_path = scratch("details")
    fx.land_detail_payloads(spark, SF_SMALL, details_path)

    counts = ingest_daily(spark, land, log, dead, as_of="2024-01-16", current_path=cur,
                          run_ts="2024-01-16 18:00:00", load_id="d1")
    assert counts["total"] > 0 and counts["success"] + counts["rejected"] == counts["total"]
    counts = ingest_daily(spark, land, log, dead, dates=["2024-01-16", "2024-01-17"],
                          current_path=cur, run_ts="2024-01-17 18:00:00", load_id="d2")
    prices = read_current(spark, cur)
    assert prices.select("date").distinct().count() == 3  # 15th (as_of 16th), 16th, 17th

    details = read_detail_payloads(spark, details_path)
    run = construct.index_build_range(prices, details, "2024-01-01", "2024-01-31", top_n=5)
    comp_path = scratch("comp")
    append_composition(run, comp_path, run_ts="2024-01-17 18:00:00")
    comp = scan_table(spark, comp_path, "index_composition")
    # bars here are one per event, so a ticker can fill several top-5 slots of a day;
    # the composition key keeps one row per (date, ticker, type, run), as ON CONFLICT does
    keys = run.select("index_type", "date", "ticker").distinct().count()
    assert comp.count() == keys and comp.select("date").distinct().count() == 3

    perf = performance.track_index_performance(prices, comp, "2024-01-01", "2024-01-31")
    perf_path = scratch("perf")
    append_performance(perf, perf_path, run_ts="2024-01-17 18:00:00")
    stored_perf = scan_table(spark, perf_path, "index_performance")
    first = stored_perf.filter(F.col("date") == "2024-01-15").collect()
    assert len(first) == 2 and all(r.daily_return == 0.0 for r in first)

    chg = changes.detect_index_changes(comp, "2024-01-01", "2024-01-31", "Equal Weighted")
    assert chg.count() >= 1  # the first day always reports (no previous snapshot)
    snap = versions.composition_snapshot(comp, "2024-01-17", "Market-Cap Weighted").collect()
    members = (run.filter((F.col("date") == "2024-01-17") & (F.col("index_type") == "Market-Cap Weighted"))
               .select("ticker").distinct().count())
    assert len(snap) == members and [r.weight for r in snap] == sorted((r.weight for r in snap), reverse=True)
    out = export_performance(stored_perf, scratch("csv"), "Equal Weighted", "2024-01-01", "2024-01-31")
    assert out.endswith("performance_equal_weighted_2024-01-01_2024-01-31.csv")
