"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row is
computed, nothing is collected to the driver). Every query is run once
untimed first (JIT and code-generation warm-up, as in a long-running
session), then timed. Prints one JSON line; ``cold`` holds the first runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "vehicle_health",
    "driver_behavior",
    "clean_batch",
    "cleaning_stats",
    "trip_aggregate",
    "threshold_profile",
    "fleet_overview",
    "driver_console",
    "vehicle_console",
    "rank_fleet_distributed",
    "load_driver_serving",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    from fleetspark.registry import REGISTRY
    from fleetspark.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        df = REGISTRY[name][0](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    cold = {n: round(run(n), 3) for n in names}
    times = {n: round(run(n), 3) for n in names}
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "cold": cold}))


if __name__ == "__main__":
    main()
