"""Streaming ingest equals batch ingest; a restart from the checkpoint adds nothing."""

import os
import shutil

from compare import rows
from conftest import SF_SMALL
from indexforge.plans.ingest import current_prices, ingest_daily, read_current, read_price_log
from indexforge.session import local_path
from indexforge.sources import fixtures as fx
from indexforge.streaming.ingest_stream import run_ingest_stream


def _collect(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def test_stream_in_increments_equals_batch(spark, scratch):
    full = scratch("land_full")
    fx.land_bar_payloads(fx.ticks(spark, SF_SMALL), full)
    days = sorted(d for d in os.listdir(local_path(full)) if d.startswith("date="))
    blog, bdead = scratch("blog"), scratch("bdead")
    ingest_daily(spark, full, blog, bdead, run_ts="2024-03-01 00:00:00", load_id="all")
    batch = _collect(current_prices(read_price_log(spark, blog)))

    inc = scratch("land_inc")
    slog, sdead, ckpt, cur = scratch("slog"), scratch("sdead"), scratch("ckpt"), scratch("cur")
    os.makedirs(local_path(inc))
    results = []
    for chunk in (days[:10], days[10:20], days[20:]):
        for d in chunk:
            shutil.copytree(os.path.join(local_path(full), d), os.path.join(local_path(inc), d))
        results += run_ingest_stream(spark, inc, slog, sdead, ckpt, run_ts="2024-03-01 00:00:00",
                                     current_path=cur)
    assert len(results) >= 3
    assert _collect(current_prices(read_price_log(spark, slog))) == batch
    assert _collect(read_current(spark, cur)) == batch
    again = run_ingest_stream(spark, inc, slog, sdead, ckpt, run_ts="2024-03-01 00:00:00",
                              current_path=cur)
    assert again == []
    assert _collect(current_prices(read_price_log(spark, slog))) == batch
