"""Summarize the final (post-AQE) physical plan of every registered query into PLANS.md.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md
Counts shuffles (hash / range / single-partition exchanges), broadcasts, join
strategies, map-side window limits and aggregate kinds, and lists the columns
each parquet scan reads.
"""

from __future__ import annotations

import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "reused": r"Reused(Exchange|Subquery)",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "BNLJ": r"BroadcastNestedLoopJoin",
    "WGL partial": r"WindowGroupLimit.*Partial",
    "Window": r"\bWindow \[",
    "HashAgg": r"\bHashAggregate\(",
    "ObjectHashAgg": r"ObjectHashAggregate\(",
    "SortAgg": r"SortAggregate\(",
}


def main():
    from airmart.plans import registry
    from airmart.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16, extra={"spark.ui.showConsoleProgress": "false"})
    qs = registry.queries()
    names = [n for n in qs if n not in registry.LANDED]
    print("# Physical plans of the registered queries\n")
    print(f"Final adaptive plans after execution at `{os.path.basename(sf)}` on local[8] "
          "(generated by `scripts/plan_report.py`). Build-stage queries read the materialized landing/clean "
          "tables, serving queries the materialized star.\n")
    print("| query | sec | " + " | ".join(PATTERNS) + " | parquet scans: columns read |")
    print("|" + " --- |" * (len(PATTERNS) + 3))
    for name in names:
        df = qs[name](spark, sf)
        df.collect()
        t = time.perf_counter()
        df2 = qs[name](spark, sf)
        df2.collect()
        sec = time.perf_counter() - t
        plan = df2._jdf.queryExecution().executedPlan().toString()
        if "== Final Plan ==" in plan:
            plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
        widths = ",".join(str(len([c for c in s.split(",") if c.strip()])) for s in scans)
        print(f"| {name} | {sec:.2f} | " + " | ".join(counts) + f" | {widths} |")
    print(NOTES)


NOTES = """
Seconds include collecting the result to the driver (this report's only use of `collect`).

## Review notes

* Joins carry no hints. At this size Spark's own byte statistics broadcast the dimensions; beyond its threshold
  the same plans are sort-merge joins on the keys, with AQE skew splitting.
* `dedup_latest_file` and `latest_district_aqi` carry a *partial* WindowGroupLimit below their only shuffle:
  one row per key per map task crosses the network, whatever the key skew.
* Aggregations are partial + final (HashAggregate / ObjectHashAggregate for MODE); `count(DISTINCT ..)`
  adds the Expand-based second aggregation (two hash shuffles) of Spark's distinct rewrite.
* `top_cities`, `home_metrics` and `freshness` read the latest UTC dates only: a scalar subquery over the partition
  column prunes the date folders.
* `BroadcastNestedLoopJoin` only joins one-row aggregates (report rows, J-5), a bounded 1 x 1 product.
* Range shuffles come from the `ORDER BY` of report queries whose output is small (districts, dates).
* Parquet scans read only the referenced columns (last column); the landing scan reads only the VARIANT
  paths the clean layer extracts (variant path pushdown).
"""


if __name__ == "__main__":
    main()
