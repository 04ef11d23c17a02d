"""Cleaning (P1-P6, A1, Q1, K5) on hand-written inputs and the two-row fixture."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from fleetspark.operators import cleaning
from fleetspark.plans import analytics
from fleetspark.plans import cleaning as clean_plan
from fleetspark.schema import RAW_COLUMNS
from fleetspark.sinks import writers
from fleetspark.sources import readers

# Two readings with JSON numbers (not strings): both high in RPM and hot.
def _upload(trip, device, second, **measured):
    reading = {c: 1 for c in RAW_COLUMNS}
    reading.update(tripID=trip, deviceID=device, timeStamp=f"2024-05-06 07:08:0{second}", accData="00ff" * 8,
                   battery=13.25, kpl=11.5, speed=61, dtc=0, eLoad=20.75, cTemp=97.5, rpm=2345, gps_speed=60.5)
    reading.update(measured)
    return reading


TWO_ROWS = [_upload(1, 11, 1), _upload(2, 12, 2, rpm=3000, cTemp=104, gps_speed=33.25)]


def _write_jsonl(path, rows, extra_lines=()):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.jsonl"), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
        for line in extra_lines:
            f.write(line + "\n")


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS))


def row(**kw):
    base = {c: "1" for c in RAW_COLUMNS}
    base.update({"tripID": "7", "deviceID": "3.0", "timeStamp": "2024-01-01 00:00:00", "accData": "ab"})
    base.update(kw)
    return tuple(base[c] for c in RAW_COLUMNS)


def test_two_row_fixture_end_to_end(spark, tmp_dir):
    # JSON numbers arrive as their text; a foreign record and the EOF marker
    # become all-null rows that the malformed filter drops.
    _write_jsonl(tmp_dir, TWO_ROWS, ['{"event": "test_upload", "timestamp": "x", "status": "ok"}',
                                     '{"__EOF__": true}'])
    raw = readers.read_raw_jsonl(spark, tmp_dir)
    assert raw.count() == 4
    first = raw.filter(F.col("tripID") == "1").first()
    assert first["rpm"] == "2345" and first["gps_speed"] == "60.5"
    cleaned = clean_plan.clean(raw)
    assert cleaned.count() == 2
    assert dict(cleaned.dtypes)["tripID"] == "int" and dict(cleaned.dtypes)["timeStamp"] == "timestamp"
    flagged = analytics.driver_flagged(cleaned).collect()
    assert all(r["is_high_rpm"] for r in flagged)
    assert all(r["speed_delta"] is None for r in flagged)      # first reading of each trip
    vh = analytics.vehicle_health(cleaned).collect()
    assert all(r["overheating_count"] == 1 and r["high_rpm_count"] == 1 for r in vh)
    assert all(r["low_battery_count"] == 0 and r["excessive_load_count"] == 0 and r["dtc_count"] == 0
               for r in vh)


def test_ansi_safe_casts_and_nan(spark):
    rows = [
        row(),
        row(deviceID="dev-x"),                 # not a number -> malformed
        row(tripID=None),                      # null trip -> malformed
        row(timeStamp="not-a-time"),           # unparsable time -> null -> dropped
        row(rpm=None),                         # null signal -> dropped
        row(kpl="NaN"),                        # NaN -> dropped like null
        row(tripID="99999999999"),             # digits but overflows int -> null -> dropped
        row(deviceID="1e12"),                  # a double, but not an int -> null -> dropped
        row(tripID="tripID", deviceID="deviceID"),  # embedded header
        row(tripID="12\n"),                    # Java regex lets a trailing newline pass,
    ]                                          # and the int cast trims it
    df = raw_frame(spark, rows)
    out = clean_plan.clean(df).collect()
    assert sorted(r["tripID"] for r in out) == [7, 12]
    assert all(r["deviceID"] == 3 for r in out)


def test_dedup_before_typing(spark):
    # "1" and "1.0" differ as raw strings, so both survive the exact dedup.
    df = raw_frame(spark, [row(), row(), row(rpm="1.0")])
    assert cleaning.dedup_exact(df).count() == 2
    assert cleaning.dedup_exact(cleaning.dedup_exact(df)).count() == 2   # idempotent


def test_header_rows_collapse_before_filter(spark):
    hdr = tuple(RAW_COLUMNS)
    df = raw_frame(spark, [hdr, hdr, hdr, row()])
    stats = cleaning.cleaning_stats(df).first().asDict()
    assert stats["input_rows"] == 4 and stats["after_dedup"] == 2
    assert stats["exact_duplicates_removed"] == 2
    assert stats["malformed_rows_dropped"] == 1 and stats["output_rows"] == 1


def test_stats_single_pass_match_fixture(spark, tmp_dir):
    from fleetspark import fixtures

    raw = fixtures.raw_telemetry(spark, "/root/testdata/sf0.01")
    res = clean_plan.clean_batch(raw, os.path.join(tmp_dir, "batch"))
    assert res.status == writers.PROCESSED
    s = res.stats
    assert (s["input_rows"], s["after_dedup"], s["exact_duplicates_removed"]) == (12634, 10101, 2533)
    assert s["malformed_rows_dropped"] == 41 and s["malformed_rows_counted_by_reference"] == 1
    assert s["dropped_for_null_after_cast"] == 60 and s["output_rows"] == 10000
    out = spark.read.parquet(res.path)
    sums = out.agg(F.sum("rpm"), F.sum("tripID"), F.sum("kpl")).first()
    assert tuple(sums) == (12159120.0, 7444492, 53406.537109375)
    again = clean_plan.clean_batch(raw, os.path.join(tmp_dir, "batch"))
    assert again.status == writers.SKIPPED and again.stats is None


def test_half_written_batch_is_rewritten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "half")
    os.makedirs(path)
    open(os.path.join(path, "part-00000-junk.parquet"), "w").close()   # no _SUCCESS
    df = clean_plan.clean(raw_frame(spark, [row()]))
    assert writers.write_if_absent(df, path) == writers.PROCESSED
    assert spark.read.parquet(path).count() == 1
    assert writers.write_if_absent(df, path) == writers.SKIPPED
