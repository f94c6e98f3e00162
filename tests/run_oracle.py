"""CLI: run every registered query against its DuckDB oracle.

    python tests/run_oracle.py [--exact] [sf_dir] [key ...]

``--exact`` compares floats bit for bit instead of rounded to 6 places.
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from indexforge.session import build_session  # noqa: E402


def main(argv):
    exact = "--exact" in argv
    argv = [a for a in argv if a != "--exact"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(entry.queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            ok, msg = compare(qs[k](spark, sf_dir), con, oracle[k], digits=None if exact else 6)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:300]}"
            traceback.print_exc(limit=3, file=sys.stderr)
        bad += not ok
        print(f"{'PASS' if ok else 'FAIL'} {k:32s} {time.time() - t0:6.2f}s {msg}", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
