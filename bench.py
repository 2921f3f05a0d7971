"""Times the headline queries and prints one JSON line.

Each query is run to the end into a sink that discards its rows: once to warm up, then the
best of the timed runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curbside.plans.catalog import QUERIES  # noqa: E402
from curbside.session import build_session  # noqa: E402

HEADLINE = (
    "bronze_parse", "dead_letter", "silver_clean", "deduplicate", "city_ride_metrics",
    "driver_utilization", "surge_pricing", "demand_supply_join", "funnel_analysis",
    "r01_city_dashboard", "r03_driver_leaderboard", "r04_hourly_revenue", "r05_funnel_conversion",
    "r06_demand_gap", "r07_week_over_week", "r09_peak_hours", "r10_fare_correction", "dq_summary",
    "merge_newer_wins", "changes_between", "cluster_rows_preserved", "pipeline_metrics",
    "stream_silver", "stream_city_metrics", "stream_surge",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", cpus, "bench", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        best = None
        # Streams write what they compute; one timed run is enough.
        for attempt in range(2 if name.startswith("stream") else 1 + runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if attempt:
                best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
