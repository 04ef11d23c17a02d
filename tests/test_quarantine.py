"""Rejected rows with their reasons next to the clean ones."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from fleetspark import fixtures
from fleetspark.plans import cleaning
from fleetspark.schema import RAW_COLUMNS
from fleetspark.sources import readers

SF = "/root/testdata/sf0.001"
GOOD = {c: "1.5" for c in RAW_COLUMNS} | {"tripID": "7", "deviceID": "3.0", "timeStamp": "2024-01-01 08:00:00", "accData": "a"}


def _raw(spark, *changes):
    return spark.createDataFrame([tuple((GOOD | c)[k] for k in RAW_COLUMNS) for c in changes],
                                 ", ".join(f"{c} string" for c in RAW_COLUMNS))


def test_each_fault_is_named(spark):
    cases = [({}, None), ({"accData": None}, None), ({"tripID": "tripID", "rpm": None}, ["malformed:tripID"]), ({"tripID": None}, ["malformed:tripID"]),
             ({"tripID": "x", "deviceID": "dev"}, ["malformed:tripID", "malformed:deviceID"]), ({"timeStamp": "yesterday"}, ["uncastable:timeStamp"]),
             ({"rpm": None, "kpl": "NaN", "speed": "fast"}, ["nan:kpl", "missing:rpm", "uncastable:speed"]),
             ({"tripID": "99999999999"}, ["uncastable:tripID"]), ({"deviceID": "1e30"}, ["uncastable:deviceID"]), ({"battery": ""}, ["uncastable:battery"])]
    for change, want in cases:
        (r,) = cleaning.route(_raw(spark, change)).collect()
        assert (r["reasons"], r["outcome"]) == (want, "rejected" if want else "clean"), change
        assert (r["raw"] is None) == (want is None)
        if want:
            assert r["raw"].asDict() == GOOD | change  # the row as it came


def test_outcomes_add_up_and_clean_is_what_cleaning_keeps(spark, tmp_dir):
    raw = fixtures.raw_telemetry(spark, SF)
    base = cleaning.clean_with_quarantine(raw, os.path.join(tmp_dir, "out"))
    both = spark.read.parquet(base)
    assert both.agg(F.sum("copies")).first()[0] == raw.count() and both.count() == raw.distinct().count()
    key = lambda r: repr(tuple(r))
    assert sorted(cleaning.read_clean(spark, base).collect(), key=key) == sorted(cleaning.clean(raw).collect(), key=key)
    assert cleaning.read_rejected(spark, base).count() == both.count() - cleaning.read_clean(spark, base).count() > 0


def test_one_pass(spark):
    plan = cleaning.route(fixtures.raw_telemetry(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1


def test_unreadable_lines_are_kept_apart(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    _raw(spark, {}, {}, {"rpm": None}).write.json(src)
    spark.createDataFrame([("{broken",), ("{broken",), ("[1]",)], "value string").write.mode("append").text(src)
    base = cleaning.clean_with_quarantine(readers.read_raw_jsonl_with_lines(spark, src), os.path.join(tmp_dir, "out"))
    got = {(tuple(r["reasons"]), r["raw"][readers.UNREADABLE], r["copies"]) for r in cleaning.read_rejected(spark, base).collect()}
    assert (("unreadable",), "{broken", 2) in got and (("missing:rpm",), None, 1) in got
    assert cleaning.read_clean(spark, base).count() == 1
    summary = {r["reason"]: (r["distinct_rows"], r["copies"]) for r in cleaning.rejection_summary(cleaning.read_rejected(spark, base)).collect()}
    assert summary["missing:rpm"] == (1, 1)


def test_an_empty_batch(spark, tmp_dir):
    base = cleaning.clean_with_quarantine(_raw(spark, {}).limit(0), os.path.join(tmp_dir, "out"))
    assert cleaning.read_clean(spark, base).collect() == cleaning.read_rejected(spark, base).collect() == []
