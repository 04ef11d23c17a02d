"""Batches written in clusters of device and time."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fleetspark import fixtures
from fleetspark.sinks import writers
from fleetspark.sources import readers

SF = "/root/testdata/sf0.01"


def scanned(df):
    """(rows of the row groups that the scan read, rows of the result)."""
    n = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(plan.apply(i).metrics().apply("numOutputRows").value() for i in range(plan.size())), n


@pytest.mark.parametrize("hot", [False, True])
def test_filters_on_either_column_read_few_row_groups(spark, tmp_dir, hot):
    t = fixtures.telemetry(spark, SF)
    if hot:  # one device sends a third of all readings
        t = t.withColumn("deviceID", F.when(F.pmod(F.xxhash64("rpm", "timeStamp"), F.lit(3)) == 0, F.lit(40)).otherwise(F.col("deviceID")))
    path = writers.write_clustered(t, os.path.join(tmp_dir, "z"), files=64)
    plain = os.path.join(tmp_dir, "plain")
    t.repartition(64).write.parquet(plain)
    total = t.count()
    day, one, other = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11)), (77, 78), (40, 41)
    for where, most in (({"deviceID": one, "timeStamp": day}, 0.1), ({"deviceID": one}, 0.35), ({"timeStamp": day}, 0.35),
                        ({"deviceID": other, "timeStamp": day}, 0.15), ({"timeStamp": (None, day[0])}, 0.6), ({}, 1.0)):
        rows, n = scanned(readers.read_clustered(spark, path, where))
        unclustered, same = scanned(readers.read_clustered(spark, plain, where))
        assert n == same and n <= rows <= most * total and unclustered > 0.9 * total, (where, rows, total)
    assert readers.read_clustered(spark, path, {}).exceptAll(t).isEmpty() and readers.read_clustered(spark, path, {}).count() == total
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 48 and max(sizes) < 4 * total / 64  # no file holds a hot device


def test_bits_in_turn(spark):
    df = spark.createDataFrame([(5, 3)], "a int, b int").select(writers.interleaved([F.col("a"), F.col("b")], 3).alias("z"))
    assert df.first()["z"] == 0b100111  # a = 101, b = 011


def test_nulls_and_empty(spark, tmp_dir):
    t = fixtures.telemetry(spark, "/root/testdata/sf0.001")
    odd = t.withColumn("deviceID", F.when(F.col("rpm") > 500, F.col("deviceID"))).withColumn("timeStamp", F.when(F.col("kpl") > 1, F.col("timeStamp")))
    writers.write_clustered(odd, os.path.join(tmp_dir, "odd"), files=4)
    assert readers.read_clustered(spark, os.path.join(tmp_dir, "odd"), {}).exceptAll(odd).isEmpty()
    writers.write_clustered(t.limit(0), os.path.join(tmp_dir, "none"), files=4)
