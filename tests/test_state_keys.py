"""State of the previous speeds (X5): many trips share a state key, none depends on another."""

from __future__ import annotations

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetspark.operators import windows
from fleetspark.streaming import streams

BIG = 2**60
ORDER = ("timeStamp", "speed", "rpm", "kpl", "event_id")


def _readings(spark, trips: int):
    """Four readings of each trip, some with null keys, speeds or ids; ids beyond a float's range."""
    i = F.col("id")
    null = lambda when, value: F.when(~when, value)
    return spark.range(4 * trips).select(
        null(i % 97 == 5, i % trips).cast("int").alias("tripID"), null(i % 89 == 3, i % trips).cast("int").alias("deviceID"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (i * 7919) % 1000).alias("timeStamp"),
        null(i % 11 == 2, (i * 31 % 400) / 4).alias("speed"), F.lit(1000.0).alias("rpm"), F.lit(5.0).alias("kpl"),
        (i + BIG).alias("event_id"))


def _run(spark, rows, tmp_dir, deltas):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    for part in rows:
        part.coalesce(1).write.mode("append").parquet(src)
    stream = streams.read_telemetry_stream(spark, "parquet", src, rows[0].schema, maxFilesPerTrigger=1)
    q = streams.write_append_to_parquet(deltas(stream), out, ck)
    q.awaitTermination()
    assert q.exception() is None
    keys = max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"])
    return spark.read.parquet(out), keys


def _batch(rows):
    want = windows.with_previous(rows, ["speed"], tiebreak=ORDER[1:])
    return {r.event_id: r.prev_speed for r in want.collect()}


@pytest.mark.parametrize("corrections", [False, True])
def test_trips_share_state_keys_and_keep_their_own(spark, tmp_dir, monkeypatch, corrections):
    monkeypatch.setattr(streams, "STATE_KEYS", 16)
    rows = _readings(spark, 300).cache()
    if corrections:  # in no order
        parts = [rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k) for k in range(3)]
        got, keys = _run(spark, parts, tmp_dir, lambda s: streams.stream_speed_corrections(s, "1 day", ORDER))
        got = streams.latest_revision(got, ["event_id"])
    else:
        at = F.unix_timestamp("timeStamp") - 1_700_000_000
        parts = [rows.filter((at >= lo) & (at < lo + 500)) for lo in (0, 500)]
        got, keys = _run(spark, parts, tmp_dir, lambda s: streams.stream_speed_delta(s, ORDER))
    assert keys <= 16  # Python is called once for a key and micro-batch, not once for each of 300 trips
    got = got.collect()
    assert sorted(r.event_id for r in got) == [BIG + i for i in range(1200)]
    want = {r.event_id: r for r in rows.collect()}
    before = _batch(rows)
    assert {r.event_id: r.prev_speed for r in got} == before
    for r in got:
        speed = want[r.event_id].speed
        assert r.speed_delta == (None if speed is None or before[r.event_id] is None else speed - before[r.event_id])


class _State:
    """A group state with a clock of the test's own."""

    def __init__(self):
        self.value, self.now, self.due = None, 0, None
        self.exists = self.hasTimedOut = False

    get = property(lambda self: self.value)

    def update(self, value):
        self.value, self.exists = value, True

    def remove(self):
        self.value, self.exists = None, False

    def getCurrentProcessingTimeMs(self):
        return self.now

    def setTimeoutDuration(self, ms):
        self.due = self.now + ms


@pytest.mark.parametrize("corrections", [False, True])
def test_idle_trips_go_one_by_one(spark, monkeypatch, corrections):
    rows = spark.createDataFrame([], "tripID int, deviceID int, timeStamp timestamp, speed double, rpm double, kpl double")
    taken = []
    grouped = type(rows.groupBy("tripID"))
    monkeypatch.setattr(grouped, "applyInPandasWithState", lambda self, run, out, *a: taken.append(run) or spark.createDataFrame([], out))
    (streams.stream_speed_corrections if corrections else streams.stream_speed_delta)(rows, idle_timeout="10 seconds")
    state = _State()

    def send(now, *readings):
        state.now = now
        state.hasTimedOut = not readings
        pdf = pd.DataFrame([{"tripID": t, "deviceID": 1, "timeStamp": pd.Timestamp(dt.datetime(2024, 1, 1)) + pd.Timedelta(seconds=s),
                             "speed": v, "rpm": 1.0, "kpl": 1.0, "_no_tripID": False, "_no_deviceID": False} for t, s, v in readings])
        out = [x for x in taken[0]((0,), iter([pdf]), state)]
        return {(r.tripID, r.speed): None if pd.isna(r.prev_speed) else r.prev_speed for x in out for r in x.itertuples()}

    assert send(1_000, (1, 0, 10.0), (2, 0, 20.0)) == {(1, 10.0): None, (2, 20.0): None}
    assert send(8_000, (2, 5, 21.0)) == {(2, 21.0): 20.0}
    assert state.due == 11_000                                   # the first trip's, not the last arrival's
    assert send(12_000) == {} and state.exists                   # the first trip goes, the second stays
    assert state.due == 18_000
    assert send(13_000, (1, 9, 11.0), (2, 9, 22.0)) == {(1, 11.0): None, (2, 22.0): 21.0}
    assert send(24_000) == {} and not state.exists
