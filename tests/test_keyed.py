"""Bucketed keyed tables (K7, K8): what an upsert touches, commits, retention."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from fleetspark.commits import CommitLog
from fleetspark.sinks import keyed

SCHEMA = "deviceID long, score double, processed_datestamp string"


def rows(spark, keys, score=1.0, stamp="20240101_000000"):
    return spark.createDataFrame([(k, score + (k or 0), stamp) for k in keys], SCHEMA)


def scores(df):
    return {r["deviceID"]: r["score"] for r in df.collect()}


def data_folders(base):
    return {os.path.join(d, x) for d, names, _ in os.walk(os.path.join(base, "data")) for x in names if x.startswith("_bucket=")}


def test_an_upsert_writes_only_the_buckets_of_its_keys(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t")
    table = keyed.KeyedTable(spark, base, buckets=256)
    n = 20_000
    wide = spark.range(n).select(F.col("id").alias("deviceID"), F.rand(1).alias("score"),
                                 F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2((-F.col("id")).cast("string"), 512)).alias("note"))
    whole = table.upsert(wide).bytes_written
    changed = wide.filter("deviceID % 1000 = 7").withColumn("score", F.lit(-1.0))  # 20 keys
    done = table.upsert(changed)
    want = {r[0] for r in changed.select(table._bucket(256)).distinct().collect()}
    assert set(done.buckets) == want and len(want) <= 20
    assert 0 < done.bytes_written < 0.15 * whole  # 20 of 256 buckets
    got = table.read()
    assert got.count() == n and got.filter("score = -1.0").count() == 20
    # untouched buckets are the very folders of the version before
    before, after = (table.log.read(v)["folders"] for v in (1, 2))
    assert {b for b in after if before[b] != after[b]} == set(map(str, want))


def test_one_percent_of_the_keys(spark, tmp_dir):
    """1 % of the keys, new and old ones: bytes follow the touched buckets."""
    table = keyed.KeyedTable(spark, os.path.join(tmp_dir, "t"), buckets=512)
    whole = table.upsert(spark.range(5000).select(F.col("id").alias("deviceID"), F.sha2(F.col("id").cast("string"), 512).alias("note")))
    assert len(whole.buckets) == 512
    done = table.upsert(spark.range(50).select((F.col("id") * 103).alias("deviceID"), F.lit("new").alias("note")))
    assert len(done.buckets) <= 50 and done.bytes_written < 0.3 * whole.bytes_written
    assert table.read().filter("note = 'new'").count() == 50 and table.read().count() == 5001


def test_old_versions_go_and_readers_keep_theirs(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t")
    table = keyed.KeyedTable(spark, base, buckets=8, keep=3)
    held = None
    for k in range(7):
        table.upsert(rows(spark, [1, 2, 3], score=10.0 * k))
        if k == 4:
            held = table.read()
    assert table.log.numbers() == [5, 6, 7]
    assert scores(held) == {1: 41.0, 2: 42.0, 3: 43.0}  # version 5 is still there
    named = {os.path.join(base, f) for v in (5, 6, 7) for f in table.log.read(v)["folders"].values()}
    assert named <= data_folders(base)
    unused = {os.path.join(base, f) for v in (5, 6, 7) for f in table.log.read(v)["unused"]}
    assert data_folders(base) == named | unused
    assert [r["score"] for r in table.read(5).orderBy("deviceID").collect()] == [41.0, 42.0, 43.0]


def test_two_writers_lose_nothing(spark, tmp_dir, monkeypatch):
    base = os.path.join(tmp_dir, "t")
    first, second = (keyed.KeyedTable(spark, base, buckets=4) for _ in range(2))
    first.upsert(rows(spark, range(10)))
    real, met = CommitLog.commit, []

    def slow(self, number, contents):
        if not met:  # before the first commit of this upsert another writer commits the same number
            met.append(number)
            second.upsert(rows(spark, [3], score=100.0))
        return real(self, number, contents)

    monkeypatch.setattr(CommitLog, "commit", slow)
    done = first.upsert(rows(spark, [4], score=200.0))
    assert met == [2] and done.version == 3
    got = scores(first.read())
    assert got[3] == 103.0 and got[4] == 204.0 and len(got) == 10


def test_a_commit_number_is_given_once(spark, tmp_dir):
    log = CommitLog(spark, tmp_dir)
    assert log.newest() == (0, None)
    assert log.commit(1, {"a": 1}) and not log.commit(1, {"a": 2})
    assert log.newest() == (1, {"a": 1}) and os.listdir(os.path.join(tmp_dir, "_commits")).count("0000000001.json") == 1


def test_a_failed_write_shows_nothing(spark, tmp_dir, monkeypatch):
    base = os.path.join(tmp_dir, "t")
    table = keyed.KeyedTable(spark, base, buckets=4)
    table.upsert(rows(spark, range(5)))

    def fails(self, number, contents):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", fails)
        with pytest.raises(OSError):
            table.upsert(rows(spark, range(3, 8), score=50.0), writer="s", epoch=0)
    assert scores(table.read()) == {k: 1.0 + k for k in range(5)}
    table.upsert(rows(spark, range(3, 8), score=50.0), writer="s", epoch=0)  # the retry
    assert len(scores(table.read())) == 8
    assert table.upsert(rows(spark, [0], score=99.0), writer="s", epoch=0).buckets == ()
    assert scores(table.read())[0] == 1.0


def test_new_columns_empty_rows_and_truncate(spark, tmp_dir):
    table = keyed.KeyedTable(spark, os.path.join(tmp_dir, "t"), buckets=4)
    assert table.read() is None
    with pytest.raises(FileNotFoundError):
        table.truncate()
    table.upsert(rows(spark, [1, 2]))
    table.upsert(spark.createDataFrame([(2, "x"), (9, "y")], "deviceID long, label string"))
    got = {r["deviceID"]: (r["score"], r["label"]) for r in table.read().collect()}
    assert got == {1: (2.0, None), 2: (None, "x"), 9: (None, "y")}
    table.upsert(rows(spark, []))
    assert table.read().count() == 3
    table.truncate()
    assert table.read().count() == 0 and table.read().columns == ["deviceID", "score", "processed_datestamp", "label"]
    table.upsert(rows(spark, [None, 5]))
    assert {r["deviceID"] for r in table.read().collect()} == {None, 5}
    table.upsert(rows(spark, [None], score=7.0), order_col="processed_datestamp")
    assert table.read().filter("deviceID IS NULL").count() == 1
