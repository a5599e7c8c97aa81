"""Benchmark: batch build of the mart plus the headline queries.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.

* ``build_mart``: landing table -> clean (dedup) -> hourly layer -> star schema,
  every layer written to the shared folder (median of 3 after a warm-up build; the one-row-group test file is
  dealt out to ``BENCH_CPUS`` tasks).
* every other entry: the registered query executed to completion through the
  ``noop`` sink (no driver collect), median of 3 runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "dedup_latest_file", "hourly_rollup", "daily_city_agg", "hourly_city_agg", "hourly_district_detail",
    "latest_district_aqi", "daily_district_aqi", "location_hierarchy", "top_cities", "map_summary",
    "home_metrics", "country_coverage", "aqi_daily", "aqi_current", "quality_report", "key_integrity",
    "split_valid",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    from airmart.plans import registry
    from airmart.plans.warehouse import build_warehouse
    from airmart.session import get_session, new_table_root
    from airmart.sources.readings import raw_aqi

    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                        extra={"spark.ui.showConsoleProgress": "false"})
    times: dict[str, float] = {}

    # Warm-up build (JIT, file listing caches), then the timed build.
    build_warehouse(spark, raw_aqi(spark, sf_dir, partitions=cpus), new_table_root(spark, "bench-warm"))
    builds = []
    for _ in range(3):
        t0 = time.perf_counter()
        wh = build_warehouse(spark, raw_aqi(spark, sf_dir, partitions=cpus), new_table_root(spark, "bench"))
        builds.append(time.perf_counter() - t0)
    times["build_mart"] = statistics.median(builds)
    registry._BUILDS[(spark.conf.get("spark.app.id", None) or id(spark), sf_dir)] = wh

    qs = registry.queries()
    for name in HEADLINE:
        runs = []
        for i in range(4):
            t = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t)
        times[name] = statistics.median(runs)

    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": {k: round(v, 3) for k, v in times.items()}, "sf": sf, "cpus": cpus}
    print(json.dumps(out), flush=True)


if __name__ == "__main__":
    main()
