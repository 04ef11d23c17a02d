"""Physical-plan properties: pruning, no single-partition rank, no big-side reshuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetspark import fixtures
from fleetspark.config import Thresholds
from fleetspark.operators import aggregates, ranking
from fleetspark.plans import analytics

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_vehicle_job_reads_only_needed_columns(spark, tmp_dir):
    t = fixtures.telemetry(spark, SF)
    path = tmp_dir + "/clean"
    t.write.parquet(path)
    plan = _plan(analytics.vehicle_health_unranked(spark.read.parquet(path)))
    schema = plan[plan.index("ReadSchema: ") + 12:].split("\n")[0]
    for used in ("deviceID", "tripID", "rpm", "cTemp", "eLoad", "battery", "dtc"):
        assert used in schema
    for unused in ("kpl", "accData", "speed", "gps_speed", "tPos"):
        assert unused not in schema, schema


def test_driver_job_prunes_columns(spark, tmp_dir):
    path = tmp_dir + "/clean"
    fixtures.telemetry(spark, SF).write.parquet(path)
    plan = _plan(analytics.driver_behavior_unranked(spark.read.parquet(path)))
    for line in plan.split("\n"):
        if "ReadSchema" in line:
            schema = line[line.index("ReadSchema"):]
            assert "accData" not in schema and "cTemp" not in schema, schema


def test_ranks_have_no_single_partition_over_devices(spark):
    unranked = analytics.driver_behavior_unranked(fixtures.telemetry(spark, SF))
    for ranked in (ranking.driver_rank(unranked), ranking.percentile_safety_score(unranked)):
        ranked.collect()
        plan = _plan(ranked).split("== Initial Plan ==")[0].split("\n")
        # the only single-partition step is the prefix sum over one row per
        # partition (the per-partition counts), never the devices themselves
        singles = [i for i, ln in enumerate(plan) if "Exchange SinglePartition" in ln]
        assert singles
        for i in singles:
            assert "HashAggregate(keys=[_pid" in plan[i + 1], plan[i + 1]


def test_previous_reading_scans_shuffles_and_sorts_once(spark, tmp_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        path = tmp_dir + "/clean"
        fixtures.telemetry(spark, SF).write.parquet(path)
        df = analytics.driver_flagged(spark.read.parquet(path), Thresholds())
        df.collect()
        lines = _plan(df).split("== Initial Plan ==")[0].split("\n")
        assert sum("FileScan" in ln for ln in lines) == 1 or any("ReusedExchange" in ln for ln in lines), lines
        assert not any("SortAggregate" in ln for ln in lines)
        # the readings reach the join as the window left them
        j = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln)
        left = lines[j + 1:j + 3]
        assert any("Window" in ln for ln in left) and not any("Exchange" in ln for ln in left), left
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_trips_are_counted_without_a_distinct_exchange(spark):
    rows = [(trip, device, f"2024-01-01 {h:02d}:{m:02d}:00", float(m), 900.0, 5.0)
            for device, trips in ((1, range(300)), (2, [7, 8]), (3, [None]), (None, [1, None])) for trip in trips
            for h in (0, 1, 5) for m in (0, 0, 30)]
    df = spark.createDataFrame(rows, "tripID int, deviceID int, timeStamp string, speed double, rpm double, kpl double")
    df = df.withColumn("timeStamp", F.col("timeStamp").cast("timestamp"))
    for bucket in (None, 60, 3600, 86400):
        th = Thresholds(lag_bucket_seconds=bucket)
        flagged = analytics.driver_flagged(df, th)
        got = aggregates.driver_aggregate(flagged, th)
        want = aggregates.driver_aggregate(flagged.drop(aggregates.TRIP_START), th)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert {r.deviceID: r.total_trips for r in got.collect()} == {1: 300, 2: 2, 3: 0, None: 1}
    lines = _plan(got).split("== Initial Plan ==")[0].split("\n")
    # the last exchange is of whole devices; none is of (device, trip) pairs
    assert not any("hashpartitioning(deviceID" in ln and "tripID" in ln for ln in lines)
    assert sum("HashAggregate" in ln for ln in lines) == 2, lines


def test_partitioned_batches_are_pruned(spark, tmp_dir):
    from fleetspark.sinks import writers
    from fleetspark.sources import readers

    base = tmp_dir + "/processed"
    t = fixtures.telemetry(spark, SF)
    for stamp in ("20240101_000000", "20240301_000000", "20240201_000000"):
        writers.write_batch_partition(t, base, stamp)
    writers.write_batch_partition(t.limit(10), base, "20240201_000000")   # replaces only that batch
    assert readers.batch_partitions(spark, base) == ["20240301_000000", "20240201_000000", "20240101_000000"]
    latest = readers.read_batch_partition(spark, base)
    assert {p.split("/")[-2] for p in latest.inputFiles()} == {"batch=20240301_000000"}
    assert latest.first()["batch"] == "20240301_000000"
    assert latest.count() == t.count()
    assert readers.read_batch_partition(spark, base, "20240201_000000").count() == 10
    assert spark.read.parquet(base).count() == 2 * t.count() + 10


def test_a_batch_gets_files_by_its_size(spark, tmp_dir):
    from fleetspark.sinks import writers

    t = fixtures.telemetry(spark, SF).repartition(8)
    writers.write_batch_partition(t, tmp_dir + "/days", F.date_format("timeStamp", "yyyyMMdd"))
    files = [p for p in spark.read.parquet(tmp_dir + "/days").inputFiles()]
    assert len(files) <= 31
