"""Benchmark of the headline jobs; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Jobs (fx_bars_wide = one bar per supplier and ship day of lineitem):
  prepare_prices  bars from lineitem, range-partitioned by (date, ticker)
  build     index_build_range: EW + MCW, top 100, every weekday, appended as a versioned table
  track     track_index_performance over the stored composition, all dates
  changes   detect_index_changes over the stored composition, all dates
  rebuild   a second build run appended, then latest-version snapshot of every date
  ingest    batch ingest of landed grouped-daily payloads + dead letters, merged into the
            current price table (key-day partitions); landing them is not timed
Each job runs to completion (written or sunk to ``noop``); times are wall seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from indexforge.constants import DEFAULT_TOP_N, INDEX_TYPES  # noqa: E402
from indexforge.operators import changes as chg  # noqa: E402
from indexforge.operators import construct as con  # noqa: E402
from indexforge.operators import performance as perf  # noqa: E402
from indexforge.operators import versions as ver  # noqa: E402
from indexforge.plans.ingest import (  # noqa: E402
    ingest_daily, read_current, write_prices,
)
from indexforge.session import build_session, scratch_path  # noqa: E402
from indexforge.sinks.versioned import append_composition  # noqa: E402
from indexforge.sources import fixtures as fx  # noqa: E402
from indexforge.sources.tables import scan_table  # noqa: E402


def _sink(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", "indexforge-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    times = {}
    # untimed warm-up (JIT / codegen) on the smallest tables
    warm = sf_dir.rstrip("/").rsplit("/", 1)[0] + "/sf0.001"
    if os.path.isdir(warm):
        _sink(con.build_index(fx.bars(spark, warm), fx.instruments(spark, warm), 5))

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    # a prices table as the index jobs read it: Parquet in ranges of (date, ticker)
    prices_path = scratch_path(spark, "bench_prices")
    timed("prepare_prices", lambda: write_prices(fx.bars_wide(spark, sf_dir), prices_path))
    prices = scan_table(spark, prices_path, "stock_prices")
    instruments = fx.instruments_wide(spark, sf_dir)
    comp_path = scratch_path(spark, "bench_composition")

    timed("build", lambda: append_composition(
        con.index_build_range(prices, instruments, "1990-01-01", "2010-12-31", DEFAULT_TOP_N,
                              INDEX_TYPES), comp_path, "2024-02-01 00:00:00"))
    comp = scan_table(spark, comp_path, "index_composition")
    timed("track", lambda: _sink(perf.track_index_performance(prices, comp)))
    timed("changes", lambda: _sink(chg.detect_index_changes(comp)))

    def rebuild():
        second = con.build_index(prices.filter(F.dayofmonth("date") % 2 == 0), instruments, 50)
        append_composition(second, comp_path, "2024-02-02 00:00:00")
        _sink(ver.composition_snapshot(scan_table(spark, comp_path, "index_composition")))
    timed("rebuild", rebuild)

    land = scratch_path(spark, "bench_landing")
    fx.land_bar_payloads(fx.ticks(spark, sf_dir), land)

    def ingest():
        log, dead = scratch_path(spark, "bench_log"), scratch_path(spark, "bench_dead")
        current = scratch_path(spark, "bench_current")
        ingest_daily(spark, land, log, dead, run_ts="2024-03-01 00:00:00", load_id="bench",
                     current_path=current)
        _sink(read_current(spark, current))
    timed("ingest", ingest)

    total = round(sum(v for k, v in times.items()), 3)
    print(json.dumps({"metric": "headline_jobs_total", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace('.', '', 1).isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
