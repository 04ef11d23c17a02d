"""Scores kept current from batches (Q2, Q3) against one run over all readings."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from fleetspark import fixtures
from fleetspark.plans import analytics, incremental
from fleetspark.sinks.keyed import KeyedTable

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def parts(t, n):
    """Batches in order of time; the edges cut trips."""
    day = F.dayofmonth("timeStamp")
    edges = [1 + 31 * k // n for k in range(n)] + [32]
    return [t.filter((day >= a) & (day < b)) for a, b in zip(edges, edges[1:])]


@pytest.mark.parametrize("n", [1, 4])
def test_batches_merged_equal_one_run(spark, tmp_dir, n):
    t = fixtures.telemetry(spark, SF)
    hot = t.withColumn("deviceID", F.when(F.pmod(F.xxhash64("tripID"), F.lit(3)) == 0, F.lit(1)).otherwise(F.col("deviceID")))
    for name, df in (("plain", t), ("a device with a third of all trips", hot)):
        state = incremental.FleetState(spark, os.path.join(tmp_dir, name.replace(" ", "_")), buckets=4)
        assert [state.apply(p, k) for k, p in enumerate(parts(df, n))] == [True] * n
        assert rows(state.driver_performance()) == rows(analytics.driver_behavior(df)), name
        assert rows(state.vehicle_health()) == rows(analytics.vehicle_health(df)), name
        assert state.apply(parts(df, n)[0], 0) is False  # a batch counts once


def test_a_batch_that_failed_half_way_is_added_once(spark, tmp_dir, monkeypatch):
    t = fixtures.telemetry(spark, SF)
    first, second = parts(t, 2)
    for fails in ("trips", "tails", "devices"):
        base = os.path.join(tmp_dir, fails)
        state = incremental.FleetState(spark, base)
        state.apply(first, 0)
        real = KeyedTable.combine

        def combine(self, *args, **kw):
            if self.base.endswith(fails):
                raise OSError("lost")
            return real(self, *args, **kw)

        with monkeypatch.context() as m:
            m.setattr(KeyedTable, "combine", combine)
            with pytest.raises(OSError):
                state.apply(second, 1)
        assert incremental.FleetState(spark, base).apply(second, 1)
        assert rows(state.driver_performance()) == rows(analytics.driver_behavior(t)), fails


def test_a_batch_reads_no_history(spark, tmp_dir):
    """What a later batch reads are its own readings and the touched states."""
    t = fixtures.telemetry(spark, SF)
    state = incremental.FleetState(spark, tmp_dir)
    first, second = parts(t, 2)
    staged = os.path.join(tmp_dir, "first")
    first.write.parquet(staged)
    state.apply(spark.read.parquet(staged), 0)
    os.rename(staged, staged + "-gone")  # the first batch's readings are away
    state.apply(second, 1)
    assert rows(state.vehicle_health()) == rows(analytics.vehicle_health(t))


def test_odd_batches(spark, tmp_dir):
    t = fixtures.telemetry(spark, SF)
    state = incremental.FleetState(spark, tmp_dir)
    with pytest.raises(FileNotFoundError):
        state.measures()
    odd = t.limit(40).unionByName(t.limit(3).withColumn("deviceID", F.lit(None).cast("int")))
    odd = odd.unionByName(t.limit(2).withColumn("tripID", F.lit(None).cast("int"))).unionByName(t.limit(2).withColumn("tripID", F.lit(-5)))
    state.apply(t.limit(0), 0)
    state.apply(odd, 1)
    want = analytics.fleet_aggregate(odd).select(state.measures().columns)
    assert rows(state.measures()) == rows(want)
