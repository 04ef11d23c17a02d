"""Streaming state across micro-batches (X5) and windowed counts."""

from __future__ import annotations

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from fleetspark import fixtures
from fleetspark.plans import pipeline
from fleetspark.sources import batches, readers
from fleetspark.streaming import streams

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
SCHEMA = "tripID int, deviceID int, timeStamp timestamp, speed double, rpm double, kpl double"


def _write_batches(spark, path, batches):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)   # distinct modification times keep the file order


def _r(trip, sec, speed):
    return (trip, 1, T0 + dt.timedelta(seconds=sec), speed, 1000.0, 5.0)


def test_speed_delta_state_and_late_rows(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    _write_batches(spark, src, [
        [_r(1, 0, 10.0), _r(1, 10, 20.0), _r(2, 0, 7.0)],
        [_r(1, 20, 50.0), _r(1, 5, 99.0)],          # t=5 arrives after t=10: out of order
        [_r(1, 30, 40.0), _r(2, 40, 9.0)],
    ])
    stream = streams.read_telemetry_stream(spark, "parquet", src, spark.createDataFrame([], SCHEMA).schema,
                                           maxFilesPerTrigger=1)
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = streams.write_append_to_parquet(streams.stream_speed_delta(stream), out, ck)
    q.awaitTermination()
    assert q.exception() is None
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    got = {(r["tripID"], int((r["timeStamp"] - T0).total_seconds())): (r["prev_speed"], r["speed_delta"])
           for r in spark.read.parquet(out).collect()}
    assert got[(1, 0)] == (None, None)
    assert got[(1, 10)] == (10.0, 10.0)
    assert got[(1, 20)] == (20.0, 30.0)      # carried across micro-batches
    assert got[(1, 5)] == (None, None)       # late reading: no delta
    assert got[(1, 30)] == (50.0, -10.0)
    assert got[(2, 40)] == (7.0, 2.0)


def test_alert_windows_append_mode(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    rows = [(1, 1, T0 + dt.timedelta(hours=h), 10.0, 2500.0, 5.0) for h in (0, 1, 25, 49)]
    spark.createDataFrame(rows, SCHEMA).withColumns(
        {"cTemp": F.lit(95.0), "eLoad": F.lit(10.0), "battery": F.lit(12.5), "dtc": F.lit(0.0)}
    ).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = streams.read_telemetry_stream(spark, "parquet", src, schema)
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = streams.write_append_to_parquet(streams.stream_alert_windows(stream, "1 day", "1 hour"), out, ck)
    q.awaitTermination()
    got = sorted((r["window_start"].day, r["readings"], r["alert_rows"]) for r in spark.read.parquet(out).collect())
    # append mode emits only windows closed by the watermark (the last day stays open)
    assert got == [(1, 2, 2), (2, 1, 1)]


def _run_deltas(spark, src, out, ck):
    stream = streams.read_telemetry_stream(spark, "parquet", src, spark.createDataFrame([], SCHEMA).schema,
                                           maxFilesPerTrigger=1)
    q = streams.write_append_to_parquet(streams.stream_speed_delta(stream), out, ck)
    q.awaitTermination()
    assert q.exception() is None
    return {(r["tripID"], int((r["timeStamp"] - T0).total_seconds())): r["prev_speed"]
            for r in spark.read.parquet(out).collect()}


def test_a_bad_clock_touches_its_own_trip_only(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    late = (77, 1, dt.datetime(2099, 1, 1), 5.0, 1000.0, 5.0)
    _write_batches(spark, src, [[_r(t, 0, 10.0 + t) for t in range(20)] + [late], [_r(t, 1, 20.0) for t in range(20)]])
    got = _run_deltas(spark, src, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    assert all(got[(t, 1)] == 10.0 + t for t in range(20))


def test_state_survives_a_restart(spark, tmp_dir):
    """Also where the session's partition count has changed (a stream keeps
    the count its checkpoint began with; keys do not depend on it)."""
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for k, n in enumerate(("2", "3")):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            _write_batches(spark, src, [[_r(t, k, 10.0 * k + t) for t in range(20)]])
            got = _run_deltas(spark, src, out, ck)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert all(got[(t, 1)] == float(t) for t in range(20))


def test_closing_heartbeat_and_late_counter(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    schema = spark.createDataFrame([], SCHEMA + ", cTemp double, eLoad double, battery double, dtc double").schema
    more = (95.0, 10.0, 12.5, 0.0)
    day4 = [(1, 1, T0 + dt.timedelta(days=3, hours=h), 1.0, 2500.0, 5.0) + more for h in range(2)]
    for rows in ([_r(1, 0, 1.0) + more], day4[:1], day4[1:], [_r(1, 9, 1.0) + more]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    streams.heartbeat(schema, T0 + dt.timedelta(days=30), spark).coalesce(1).write.mode("append").parquet(src)
    stream = streams.read_telemetry_stream(spark, "parquet", src, schema, maxFilesPerTrigger=1)
    q = streams.write_append_to_parquet(streams.stream_alert_windows(stream, "1 day", "1 hour"), out, ck)
    q.awaitTermination()
    assert q.exception() is None
    got = sorted((r["window_start"].day, r["readings"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, 1), (4, 2)]            # both days came out, the heartbeat's own did not
    assert streams.dropped_late(q) == 1       # the reading of day 1 that came after day 4


def test_clean_counts_copies_across_micro_batches(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    raw = fixtures.raw_telemetry(spark, "/root/testdata/sf0.001")
    for _ in range(2):
        raw.coalesce(1).write.mode("append").json(src)
    stream = streams.read_telemetry_stream(spark, "json", src, maxFilesPerTrigger=1)
    q = streams.write_append_to_parquet(streams.stream_clean(stream), out, ck)
    q.awaitTermination()
    assert q.exception() is None
    assert spark.read.parquet(out).count() == 1000
    seen = [p["observedMetrics"] for p in q.recentProgress if p["numInputRows"] > 0]
    arrived = sum(m["stream_clean_stats_in"]["arrived"] for m in seen)
    distinct = sum(m["stream_clean_stats"]["after_dedup"] for m in seen)
    assert arrived == 2 * raw.count() and distinct == raw.distinct().count()


def test_landing_goes_on_where_it_stopped(spark, tmp_dir):
    msgs, base = os.path.join(tmp_dir, "messages"), os.path.join(tmp_dir, "lake")
    row = '{"tripID": "%d", "deviceID": "1"}'
    spark.createDataFrame([(row % i,) for i in range(5)], "value string").write.mode("append").text(msgs)
    first = pipeline.land_messages(spark, base, "20240101_000000", "text", msgs)
    assert pipeline.land_messages(spark, base, "20240102_000000", "text", msgs) is None   # nothing new
    spark.createDataFrame([(row % i,) for i in range(5, 8)], "value string").write.mode("append").text(msgs)
    second = pipeline.land_messages(spark, base, "20240103_000000", "text", msgs)
    got = [sorted(r["tripID"] for r in readers.read_raw_jsonl(spark, p).collect()) for p in (first, second)]
    assert got == [list("01234"), list("567")]
    assert batches.latest_batch_path(spark, base + "/raw", "vehicle_telematics_") == ("20240103_000000", "file:" + second)
