"""Keyed snapshots, items, batch discovery, notifications."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from fleetspark.operators import joins
from fleetspark.sinks import keyed
from fleetspark.sources import batches, readers
from fleetspark.streaming import streams

ITEM_SCHEMA = "deviceID long, score double, category string, processed_datestamp string"


def test_upsert_added_changed_vanished(spark, tmp_dir):
    old = spark.createDataFrame([(1, 90.0, "Eco Driver", "20240101_000000"),
                                 (2, 55.0, "Normal Driver", "20240101_000000"),
                                 (3, 10.0, "Aggressive Driver", "20240101_000000")], ITEM_SCHEMA)
    new = spark.createDataFrame([(2, 85.0, "Eco Driver", "20240102_000000"),      # changed
                                 (4, 70.0, "Normal Driver", "20240102_000000")],  # added
                                ITEM_SCHEMA)
    base = os.path.join(tmp_dir, "snap")
    keyed.upsert_snapshot(old, base)
    keyed.upsert_snapshot(new, base)
    got = {r["deviceID"]: (r["score"], r["processed_datestamp"]) for r in keyed.read_snapshot(spark, base).collect()}
    assert got == {1: (90.0, "20240101_000000"), 2: (85.0, "20240102_000000"),
                   3: (10.0, "20240101_000000"), 4: (70.0, "20240102_000000")}
    # idempotent: the same upsert again changes nothing
    keyed.upsert_snapshot(new, base)
    again = {r["deviceID"]: (r["score"], r["processed_datestamp"]) for r in keyed.read_snapshot(spark, base).collect()}
    assert again == got
    # truncate keeps the schema, removes the items
    keyed.truncate_keyed(spark, base)
    empty = keyed.read_snapshot(spark, base)
    assert empty.count() == 0 and empty.columns == ["deviceID", "score", "category", "processed_datestamp"]


def _items(spark, rows):
    return spark.createDataFrame(rows, ITEM_SCHEMA)


def _scores(spark, base):
    return {r["deviceID"]: r["score"] for r in keyed.read_snapshot(spark, base).collect()}


def test_stream_epochs_take_the_next_free_version(spark, tmp_dir):
    base = os.path.join(tmp_dir, "snap")
    for k in range(3):  # a batch loader wrote versions 1 to 3
        keyed.upsert_snapshot(_items(spark, [(k, 1.0, "a", "20240101_000000")]), base)
    first = _items(spark, [(10, 5.0, "a", "20240102_000000")])
    keyed.upsert_snapshot(first, base, order_col="processed_datestamp", writer="s1", epoch=0)
    assert _scores(spark, base) == {0: 1.0, 1: 1.0, 2: 1.0, 10: 5.0}
    # a retry of the epoch writes nothing; another stream's same epoch does
    path = keyed.current_version_path(spark, base)
    assert keyed.upsert_snapshot(_items(spark, [(10, 9.0, "a", "20240103_000000")]), base,
                                 order_col="processed_datestamp", writer="s1", epoch=0) == path
    keyed.upsert_snapshot(_items(spark, [(11, 6.0, "a", "20240102_000000")]), base,
                          order_col="processed_datestamp", writer="s2", epoch=0)
    assert _scores(spark, base) == {0: 1.0, 1: 1.0, 2: 1.0, 10: 5.0, 11: 6.0}


def test_a_stale_file_does_not_bring_back_older_items(spark, tmp_dir):
    base, src = os.path.join(tmp_dir, "snap"), os.path.join(tmp_dir, "in")
    keyed.upsert_snapshot(_items(spark, [(1, 50.0, "a", "20240105_000000")]), base)
    for k, rows in enumerate([[(1, 60.0, "a", "20240106_000000"), (2, 20.0, "a", "20240106_000000")],
                              [(1, 10.0, "a", "20240101_000000"), (3, 30.0, "a", "20240101_000000")]]):
        _items(spark, rows).coalesce(1).write.mode("append").parquet(src)
        ck = os.path.join(tmp_dir, f"ck{k}")  # each run with a new checkpoint: epochs start again
        stream = spark.readStream.schema(ITEM_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        q = streams.stream_upsert_scores(stream, base, ck)
        q.awaitTermination()
        assert q.exception() is None
    assert _scores(spark, base) == {1: 60.0, 2: 20.0, 3: 30.0}


def test_reconcile_statuses(spark):
    a = spark.createDataFrame([(1, 90.00001, "x"), (2, 50.0, "y"), (3, 10.0, "z")],
                              "deviceID long, score double, label string")
    b = spark.createDataFrame([(1, 90.0, "x"), (2, 51.0, "y"), (4, 1.0, "w")],
                              "deviceID long, score double, label string")
    got = {r["deviceID"]: r["status"] for r in joins.reconcile_stores(a, b, "deviceID", ["score", "label"]).collect()}
    assert got == {1: "match", 2: "mismatch", 3: "only_a", 4: "only_b"}


def test_latest_batch_and_unstamped_paths(spark):
    paths = spark.createDataFrame([
        ("s3a://b/curated/uc2/driver_performance_20240101_101010/",),
        ("s3a://b/curated/uc2/driver_performance_20240301_000000/",),
        ("s3a://b/curated/uc2/driver_performance_20240215_235959/",),
        ("s3a://b/curated/uc2/driver_performance_manual/",),
    ], "path string")
    listed = batches.list_batches(paths).collect()
    assert [r["datestamp"] for r in listed] == ["20240301_000000", "20240215_235959", "20240101_101010"]
    best = batches.latest_batch(paths).first()
    assert best["datestamp"] == "20240301_000000" and best["path"].endswith("20240301_000000/")
    none = spark.createDataFrame([("x/manual/",)], "path string")
    try:
        batches.latest_batch(none).collect()
        raise AssertionError("expected a failure without stamped batches")
    except Exception as e:  # noqa: BLE001
        assert "no stamped batch" in str(e)


def test_batch_folders_on_disk(spark, tmp_dir):
    df = spark.range(3).withColumnRenamed("id", "deviceID")
    for stamp in ("20240101_000000", "20240105_000000", "20240103_000000"):
        df.write.parquet(os.path.join(tmp_dir, f"driver_performance_{stamp}"))
    stamp, path = batches.latest_batch_path(spark, tmp_dir, "driver_performance_")
    assert stamp == "20240105_000000" and path.endswith("driver_performance_20240105_000000")


def test_unfinished_batches_and_single_objects(spark, tmp_dir):
    df = spark.range(3).withColumnRenamed("id", "deviceID")
    df.write.parquet(os.path.join(tmp_dir, "raw_20240101_000000"))
    df.write.parquet(os.path.join(tmp_dir, "raw_20240109_000000"))
    os.remove(os.path.join(tmp_dir, "raw_20240109_000000", "_SUCCESS"))   # still being written
    with open(os.path.join(tmp_dir, "raw_20240105_000000.jsonl"), "w") as f:
        f.write('{"deviceID": "1"}\n')
    stamp, path = batches.latest_batch_path(spark, tmp_dir, "raw_")
    assert stamp == "20240105_000000" and path.endswith("raw_20240105_000000.jsonl")
    assert [r["datestamp"] for r in batches.list_batches(batches.batch_paths(spark, tmp_dir)).collect()] == [
        "20240105_000000", "20240101_000000"]
    assert readers.read_raw_jsonl(spark, path).first()["deviceID"] == "1"


def test_file_event_parsing(spark):
    msgs = spark.createDataFrame([
        ('{"Records": [{"s3": {"bucket": {"name": "bk"}, "object": {"key": "raw/a_20240101_000000.jsonl"}}}]}',),
        ('{"event": "test_upload", "timestamp": "2024-01-01", "status": "ok"}',),
        ('not json',),
        ('{"Records": []}',),
        ('{"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "x"}}}, '
         '{"s3": {"bucket": {"name": "b"}, "object": {"key": "y"}}}, {"s3": {}}]}',),
    ], "value string")
    got = [tuple(r) for r in batches.parse_file_events(msgs).collect()]
    assert got == [("bk", "raw/a_20240101_000000.jsonl"), ("b", "x"), ("b", "y")]


def test_eof_and_csv_headers(spark, tmp_dir):
    msgs = spark.createDataFrame([('{"tripID": "1", "rpm": "2"}',), ('{"__EOF__": true}',)], "value string")
    parsed = streams.raw_readings(msgs).collect()
    assert len(parsed) == 1 and parsed[0]["tripID"] == "1" and parsed[0]["rpm"] == "2"
    path = os.path.join(tmp_dir, "csv")
    os.makedirs(path)
    header = "tripID,deviceID,timeStamp,accData,gps_speed,battery,cTemp,dtc,eLoad,iat,imap,kpl,maf,rpm,speed,tAdv,tPos"
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write(header + "\n" + "1,2.0,2024-01-01 00:00:00,ab,1,12,90,0,10,1,1,1,1,900,1,1,1\n" + header + "\n")
    rows = readers.read_raw_csv(spark, path).collect()
    assert len(rows) == 2 and rows[1]["tripID"] == "tripID"    # embedded header stays in
    other = os.path.join(tmp_dir, "csv2")
    os.makedirs(other)
    with open(os.path.join(other, "a.csv"), "w") as f:   # other order, one more column, some missing
        f.write("speed,note,deviceID,tripID\n61,hello,2.0,130\n")
    got = readers.read_raw_csv(spark, other).first()
    assert (got["tripID"], got["deviceID"], got["speed"], got["rpm"]) == ("130", "2.0", "61", None)
    with open(os.path.join(other, "b.csv"), "w") as f:   # a folder whose files disagree fails
        f.write("tripID,deviceID,speed,note\n1,2,3,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_raw_csv(spark, other).collect()


def test_items_drop_nulls_in_json(spark):
    df = spark.createDataFrame([(1, None, "Eco Driver")], "deviceID long, score double, cat string")
    payload = df.select(F.to_json(F.struct("*")).alias("v")).first()["v"]
    assert payload == '{"deviceID":1,"cat":"Eco Driver"}'
