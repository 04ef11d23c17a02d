"""The whole pipeline on the smallest fixture: CSV → messages → raw batch →
cleaned batch → curated scores → serving stores → console tables."""

from __future__ import annotations

import os

from fleetspark import fixtures
from fleetspark.plans import analytics, pipeline
from fleetspark.sinks import keyed, writers


def test_pipeline_end_to_end(spark, tmp_dir):
    sf = "/root/testdata/sf0.001"
    csv = os.path.join(tmp_dir, "csv")
    fixtures.raw_telemetry(spark, sf).write.option("header", True).csv(csv)
    msgs = os.path.join(tmp_dir, "messages")
    pipeline.publish_messages(spark, csv, msgs)
    base, serving = os.path.join(tmp_dir, "lake"), os.path.join(tmp_dir, "serving")
    raw_path = pipeline.land_messages(spark, base, "20240131_120000", "text", msgs)
    assert raw_path.endswith("raw/vehicle_telematics_20240131_120000")

    res = pipeline.run_cleaning(spark, base)
    assert res.status == writers.PROCESSED
    assert res.stats["input_rows"] == 1264 and res.stats["output_rows"] == 1000
    assert pipeline.run_cleaning(spark, base).status == writers.SKIPPED

    v = pipeline.run_vehicle_health(spark, base)
    d = pipeline.run_driver_behavior(spark, base)
    assert v.stamp == d.stamp == "20240131_120000"
    dl, vl = pipeline.run_loads(spark, base, serving)
    assert dl.datestamp == "20240131_120000"
    snap = keyed.read_snapshot(spark, os.path.join(serving, "keyed", "DriverPerformance"))
    assert snap.count() == 15

    # the cleaned batch scores like the clean fixture itself
    want = sorted(tuple(r) for r in analytics.vehicle_health(fixtures.telemetry(spark, sf)).collect())
    got = sorted(tuple(r) for r in spark.read.parquet(v.outputs[0]).collect())
    assert got == want

    both = pipeline.run_scores(spark, base)      # one pass rewrites the same outputs
    assert sorted(tuple(r) for r in spark.read.parquet(both.outputs[0]).collect()) == want

    prof = os.path.join(tmp_dir, "profile")
    stamp = pipeline.run_profile(spark, base, prof)
    p95 = spark.read.parquet(os.path.join(prof, f"thresholds_{stamp}")).first()["p95_rpm"]
    assert 1500 <= p95 <= 2500
    pipeline.run_inspect(spark, base, os.path.join(tmp_dir, "inspect"))
    summary = spark.read.parquet(os.path.join(tmp_dir, "inspect", "summary"))
    assert summary.filter("metric = 'rows'").first()["value"] == 1264

    out = pipeline.run_console(spark, serving)
    assert spark.read.parquet(out["drivers"]).count() == 15
    assert spark.read.parquet(out["risk_tiers"]).count() == 3
    for store in ("driver_reconciliation", "vehicle_reconciliation"):
        assert {r["status"] for r in spark.read.parquet(out[store]).collect()} == {"match"}


def test_tune_for_input(spark):
    from fleetspark.session import tune_for_input

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = tune_for_input(spark, 10 * (256 << 20), min_partitions=1)
        assert n == 10 and spark.conf.get("spark.sql.shuffle.partitions") == "10"
        assert tune_for_input(spark, 1, min_partitions=4) == 4
        assert tune_for_input(spark, 100 << 40, min_partitions=1) == 409_600   # 100 TB: no cap
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
