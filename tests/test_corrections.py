"""Previous speeds on a stream with corrections."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetspark.streaming import streams

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
SCHEMA = "tripID int, deviceID int, timeStamp timestamp, speed double, rpm double, kpl double"
SEC = 1_000_000


def batch_lag(rows):
    out, last = {}, None
    for r in sorted(rows, key=lambda r: tuple((v is not None, v or 0) for v in r)):
        out[tuple(r)] = last
        last = r[1]
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=40, unique=True),
       st.lists(st.integers(1, 6), min_size=40, max_size=40))
def test_any_arrival_within_the_lateness_equals_batch(rows, sizes):
    kept, last, i = [], {}, 0
    for n in sizes:
        part = rows[i:i + n]
        i += n
        if not part:
            break
        out, kept = streams.merge_readings(kept, [[t * SEC, s, s, 0] for t, s in part], 100 * SEC)
        for e, before, revision in out:
            key = (e[0] // SEC, e[1])
            assert revision > last.get(key, (None, -1))[1]  # corrections count up
            last[key] = (before, revision)
    assert {k: v[0] for k, v in last.items()} == batch_lag(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 400), min_size=1, max_size=8), min_size=1, max_size=12), st.integers(1, 60))
def test_state_is_bounded_and_late_rows_are_marked(parts, span):
    kept, newest = [], None
    for n, part in enumerate(parts):
        out, kept = streams.merge_readings(kept, [[t * SEC, float(n), float(n), 0] for t in part], span * SEC)
        marked = sorted(e[0] // SEC for e, _, revision in out if revision == -1)
        assert marked == sorted(t for t in part if newest is not None and t < newest - span)
        newest = max([*part, *([] if newest is None else [newest])])
        assert kept[-1][0] == newest * SEC and kept == sorted(kept, key=lambda e: (e[0], e[1]))
        assert all(e[0] >= (newest - span) * SEC for e in kept[1:])  # all but one within the span


def _r(trip, sec, speed):
    return (trip, 1, T0 + dt.timedelta(seconds=sec), speed, 1000.0, 5.0)


def _run(spark, batches, tmp_dir, **how):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
        stream = streams.read_telemetry_stream(spark, "parquet", src, spark.createDataFrame([], SCHEMA).schema, maxFilesPerTrigger=1)
        q = streams.write_append_to_parquet(streams.stream_speed_corrections(stream, **how), out, ck)  # a restart for each
        q.awaitTermination()
        assert q.exception() is None
    return spark.read.parquet(out)


@pytest.mark.parametrize("lateness, late", [("1 minute", (10.0, 89.0)), ("2 seconds", (None, None))])
def test_a_late_reading_corrects_its_successor(spark, tmp_dir, lateness, late):
    rows = _run(spark, [[_r(1, 0, 10.0), _r(1, 10, 20.0), _r(2, 0, 7.0)], [_r(1, 20, 50.0), _r(1, 5, 99.0)],
                        [_r(1, 30, None), _r(2, 40, 9.0)], [_r(1, 40, 5.0)]], tmp_dir, lateness=lateness)
    got = {(r["tripID"], int((r["timeStamp"] - T0).total_seconds())): (r["prev_speed"], r["speed_delta"])
           for r in streams.latest_revision(rows, ["tripID", "deviceID", "timeStamp"]).collect()}
    assert got[(1, 5)] == late
    assert got[(1, 10)] == ((99.0, -79.0) if late[0] else (10.0, 10.0))  # corrected, or as it was
    assert got[(1, 20)] == (20.0, 30.0) and got[(1, 30)] == (50.0, None) and got[(1, 40)] == (None, None)
    assert got[(2, 40)] == (7.0, 2.0) and got[(1, 0)] == (None, None)
    assert sorted(r["revision"] for r in rows.filter("tripID = 1 AND speed = 20").collect()) == ([0, 1] if late[0] else [0])
