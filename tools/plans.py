"""Print the physical plan shape of the main jobs (for PLANS.md).

    python tools/plans.py [--sf-dir DIR] > PLANS.md

The fixture tables are first staged the way production stores them (raw
readings as JSON lines, cleaned readings as Parquet); each job is then
planned over those files. For each job: the scans with their read schema and
pushed filters, every exchange (shuffle or broadcast) with its partitioning,
and the windows, joins and sort-based aggregates, from the final adaptive
plan after the job has run. Automatic broadcast joins are off to show the
plan a large input gets; explicit size-bounded broadcasts remain.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> list[str]:
    final = plan.split("== Initial Plan ==")[0]
    out = []
    for line in final.split("\n"):
        s = line.strip(" :+-")
        s = re.sub(r"^\*\(\d+\) ", "", s)
        if s.startswith("Exchange") or s.startswith("BroadcastExchange"):
            out.append(re.sub(r"#\d+L?", "", s.split(", [plan_id")[0].split(", ENSURE_REQUIREMENTS")[0]))
        elif "FileScan" in s or s.startswith("Scan "):
            fmt = re.search(r"(?:FileScan|Scan) (\w+)", s)
            schema = re.search(r"ReadSchema: (struct<.*?>)(?:$|,| )", s)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", s)
            out.append(f"Scan {fmt.group(1) if fmt else ''} {schema.group(1) if schema else ''}"
                       + (f" pushed={pushed.group(1)}" if pushed and pushed.group(1) != "[]" else ""))
        elif s.startswith(("Window", "SortMergeJoin", "BroadcastHashJoin", "SortAggregate", "HashAggregate",
                           "CollectMetrics", "Expand", "ObjectHashAggregate")):
            out.append(re.sub(r"#\d+L?", "", s)[:150])
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    a = ap.parse_args()

    from fleetspark import fixtures
    from fleetspark.operators import aggregates, cleaning, ranking, windows
    from fleetspark.plans import analytics, inspect
    from fleetspark.plans import cleaning as cp
    from fleetspark.session import build_session, reliable_checkpoint, work_path
    from fleetspark.sinks import keyed
    from fleetspark.sources import readers

    spark = build_session("local[8]", 8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                                                 "spark.sql.maxMetadataStringLength": "2000"})
    raw_path, clean_path = work_path(spark, "plan_raw"), work_path(spark, "plan_clean")
    fixtures.raw_telemetry(spark, a.sf_dir).write.json(raw_path)
    cp.clean(readers.read_raw_jsonl(spark, raw_path)).write.parquet(clean_path)
    raw = lambda: readers.read_raw_jsonl(spark, raw_path)          # noqa: E731
    readings = lambda: spark.read.parquet(clean_path)               # noqa: E731

    per_device = reliable_checkpoint(analytics.driver_behavior_unranked(readings()))
    jobs = {
        "Q1 clean_batch (raw JSON → typed, counters observed)": lambda: cp.clean(raw()),
        "A1 cleaning_stats": lambda: cleaning.cleaning_stats(raw()),
        "Q2 vehicle health per-device aggregate (before the rank)": lambda: analytics.vehicle_health_unranked(readings()),
        "Q3 driver behavior per-device aggregate (before the rank)": lambda: analytics.driver_behavior_unranked(readings()),
        "Q2+Q3 one-pass fleet aggregate": lambda: analytics.fleet_aggregate(readings()),
        "W3, W7 rank": lambda: ranking.driver_rank(per_device),
        "W5 percent rank": lambda: ranking.percentile_safety_score(per_device),
        "A6 trip scores": lambda: analytics.trip_scores(readings()),
        "A14 threshold profile": lambda: aggregates.threshold_profile(windows.with_speed_delta(
            readings().select("tripID", "deviceID", "timeStamp", "speed", "rpm", "kpl", "cTemp", "eLoad",
                              "battery"), tiebreak=["speed", "rpm", "kpl"])),
        "K7 keyed upsert": lambda: keyed.upsert_keyed(per_device.select("deviceID", "driver_safety_score"),
                                                      per_device.select("deviceID", "driver_safety_score")),
        "Q8 inspect summary": lambda: inspect.inspect_summary(raw()),
    }
    print("# Physical plans of the main jobs\n")
    print(__doc__.split("\n\n", 2)[2].strip() + "\n")
    for title, build in jobs.items():
        df = build()
        df.write.format("noop").mode("overwrite").save()
        lines = summarize(df._jdf.queryExecution().executedPlan().toString())
        shuffles = sum(1 for ln in lines if ln.startswith("Exchange"))
        print(f"## {title}\n\n{shuffles} shuffle exchange(s).\n\n```")
        print("\n".join(lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
