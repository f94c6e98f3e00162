"""Write PLANS.md: physical plans of the headline jobs with the facts that
matter at scale (exchanges, partial limits, broadcasts, pushed filters).

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from indexforge.operators import changes as chg  # noqa: E402
from indexforge.operators import construct as con  # noqa: E402
from indexforge.operators import performance as perf  # noqa: E402
from indexforge.operators import versions as ver  # noqa: E402
from indexforge.plans.ingest import current_prices, write_prices  # noqa: E402
from indexforge.session import build_session, scratch_path  # noqa: E402
from indexforge.sinks.versioned import append_composition  # noqa: E402
from indexforge.sources import fixtures as fx  # noqa: E402
from indexforge.sources.tables import scan_table  # noqa: E402


def facts(formatted: str) -> list[str]:
    tree, _, details = formatted.partition("\n\n")
    shuffles = len(re.findall(r"(?<!Broadcast)Exchange \(\d+\)", tree))
    partial = re.search(r"WindowGroupLimit\nInput[^\n]*\nArguments:[^\n]*Partial", details)
    out = [f"shuffle exchanges: {shuffles}",
           f"broadcast exchanges: {tree.count('BroadcastExchange')}",
           f"partial WindowGroupLimit before a shuffle: {'yes' if partial else 'no'}"]
    for pat in (r"PartitionFilters: \[[^\]]*\]", r"PushedFilters: \[[^\]]*\]",
                r"ReadSchema: struct<[^>]*>"):
        for m in sorted(set(re.findall(pat, details)))[:3]:
            out.append(f"`{m[:200]}`")
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    prices_path = scratch_path(spark, "plans_prices")
    write_prices(fx.bars_wide(spark, sf), prices_path)
    prices = scan_table(spark, prices_path, "stock_prices")
    inst = fx.instruments_wide(spark, sf)
    comp_path = scratch_path(spark, "plans_comp")
    append_composition(con.index_build_range(prices, inst, "1995-01-01", "2001-12-31", 100),
                       comp_path, "2024-02-01 00:00:00")
    comp = scan_table(spark, comp_path, "index_composition")
    jobs = {
        "index_build_range (top 100, both types, 1995-2001 weekdays)":
            con.index_build_range(prices, inst, "1995-01-01", "2001-12-31", 100),
        "track_index_performance (stored composition, 1998)":
            perf.track_index_performance(prices, comp, "1998-01-01", "1998-12-31"),
        "detect_index_changes (stored composition, 1998)":
            chg.detect_index_changes(comp, "1998-01-01", "1998-12-31"),
        "composition_snapshot (one date, one type)":
            ver.composition_snapshot(comp, "1998-06-01", "Equal Weighted"),
        "current prices from the load log (upsert)":
            current_prices(fx.bars(spark, sf).withColumn("_load_seq", F.lit(None).cast("long"))
                           .withColumn("source_file", F.lit("f"))
                           .withColumn("_pos", F.lit(0).cast("long"))),
    }
    lines = ["# PLANS", "",
             "Physical plans of the headline jobs (`tools/explain_plans.py`, sf0.01 inputs,",
             "prices written with `write_prices`, composition appended with `append_composition`).", ""]
    for name, df in jobs.items():
        formatted = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        tree = formatted.split("\n\n")[0].replace("== Physical Plan ==\n", "")
        lines += [f"## {name}", ""] + [f"* {f}" for f in facts(formatted)] + ["", "```", tree.strip(), "```", ""]
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.write("\n".join(lines))
    print(out)


if __name__ == "__main__":
    main()
