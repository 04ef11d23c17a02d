"""Salted previous-reading window equals the plain lag."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetspark.operators import windows

T0 = dt.datetime(2024, 1, 1)


def _frame(spark, n_trips=6, per_trip=400, seed=3):
    random.seed(seed)
    rows = []
    for trip in range(n_trips):
        t = T0 + dt.timedelta(hours=trip)
        for _ in range(per_trip):
            # gaps from 0 s (ties) to 2 h so readings cross many buckets
            t += dt.timedelta(seconds=random.choice([0, 1, 1, 2, 30, 900, 7200]))
            rows.append((trip, trip % 3, t, float(random.randint(0, 120)),
                         float(random.randint(600, 3000)), random.randint(0, 80) / 4))
    return spark.createDataFrame(rows, "tripID int, deviceID int, timeStamp timestamp, speed double, "
                                       "rpm double, kpl double")


def test_salted_equals_plain_lag(spark):
    df = _frame(spark).cache()
    order = ["timeStamp", "speed", "rpm", "kpl"]
    cols = ["tripID", "deviceID", *order]
    plain = df.withColumn("prev_speed",
                          F.lag("speed").over(Window.partitionBy("tripID", "deviceID").orderBy(*order)))
    want = sorted(tuple(r) for r in plain.select(*cols, "prev_speed").collect())
    for bucket in (60, 600, 3600, 86400):
        salted = windows.with_previous(df, ["speed"], tiebreak=order[1:], bucket_seconds=bucket)
        # rows equal in every ordering column are interchangeable, so the
        # multisets of (row, previous speed) must be identical
        got = sorted(tuple(r) for r in salted.select(*cols, "prev_speed").collect())
        assert got == want, bucket
    df.unpersist()


def test_salted_matches_exactly_without_ties(spark):
    rows = [(1, 1, T0 + dt.timedelta(minutes=37 * i), float(i % 17), 1000.0, 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "tripID int, deviceID int, timeStamp timestamp, speed double, "
                                     "rpm double, kpl double")
    got = windows.with_speed_delta(df).orderBy("timeStamp").select("prev_speed", "speed_delta").collect()
    assert got[0]["prev_speed"] is None
    assert [r["prev_speed"] for r in got[1:]] == [float(i % 17) for i in range(299)]


def test_gap_aware_delta(spark):
    rows = [(1, 1, T0, 10.0, 1.0, 1.0), (1, 1, T0 + dt.timedelta(seconds=1), 20.0, 1.0, 1.0),
            (1, 1, T0 + dt.timedelta(seconds=5), 5.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "tripID int, deviceID int, timeStamp timestamp, speed double, "
                                     "rpm double, kpl double")
    got = windows.with_gap_aware_speed_delta(df, 1.0).orderBy("timeStamp").collect()
    assert [r["speed_delta"] for r in got] == [None, 10.0, None]
    assert [r["gap_seconds"] for r in got] == [None, 1.0, 4.0]


def test_null_keys_and_times_equal_plain_lag(spark):
    random.seed(4)
    rows = [(random.choice([None, 1, 2]), random.choice([None, 5]),
             random.choice([None] + [T0 + dt.timedelta(minutes=17 * k) for k in range(60)]), float(i), 1.0, 1.0)
            for i in range(400)]
    df = spark.createDataFrame(rows, "tripID int, deviceID int, timeStamp timestamp, speed double, "
                                     "rpm double, kpl double")
    plain = df.withColumn("prev_speed", F.lag("speed").over(
        Window.partitionBy("tripID", "deviceID").orderBy("timeStamp", "speed")))
    got = windows.with_previous(df, ["speed"], tiebreak=["speed"], bucket_seconds=3600)
    assert sorted(map(str, got.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_one_device_with_a_third_of_the_rows(spark):
    """One long trip: its readings spread over the hour buckets' tasks."""
    rows = [(1, 1, T0 + dt.timedelta(seconds=30 * i), float(i % 50), 1.0, 1.0) for i in range(4000)]
    rows += [(2 + i % 40, 2, T0 + dt.timedelta(seconds=30 * i), float(i % 7), 1.0, 1.0) for i in range(8000)]
    df = spark.createDataFrame(rows, "tripID int, deviceID int, timeStamp timestamp, speed double, "
                                     "rpm double, kpl double")
    got = windows.with_previous(df, ["speed"], tiebreak=["speed"])
    plain = df.withColumn("prev_speed", F.lag("speed").over(
        Window.partitionBy("tripID", "deviceID").orderBy("timeStamp", "speed")))
    assert sorted(map(str, got.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tables this small are one task else
    try:
        salted = windows.with_previous(df, ["speed"], tiebreak=["speed"])
        assert salted.filter("tripID = 1").groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
