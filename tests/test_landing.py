"""Landing by manifest (X1): what readers see, retries, roll-ups."""

from __future__ import annotations

import os

import pytest

from fleetspark.commits import CommitLog, Landing
from fleetspark.sources import readers
from fleetspark.streaming import streams

ROW = '{"tripID": "%d", "deviceID": "1"}'


def _messages(spark, path, ids):
    spark.createDataFrame([(ROW % i,) for i in ids], "value string").coalesce(1).write.mode("append").text(path)


def _trips(spark, path):
    return sorted(int(r["tripID"]) for r in readers.read_raw_jsonl(spark, path).collect())


def _ingest(spark, src, out, ck):
    q = streams.stream_ingest_raw(streams.read_telemetry_stream(spark, "text", src, maxFilesPerTrigger=1), out, ck)
    q.awaitTermination()
    return q


def test_a_crash_between_files_and_commit_shows_nothing(spark, tmp_dir, monkeypatch):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    _messages(spark, src, range(3))
    _ingest(spark, src, out, ck)
    assert _trips(spark, out) == [0, 1, 2]
    _messages(spark, src, range(3, 6))

    def crash(self, number, contents):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", crash)
        with pytest.raises(Exception):
            _ingest(spark, src, out, ck)
    written = [f for d, _, fs in os.walk(out) for f in fs if f.startswith("part-")]
    assert len(written) > 1  # files of the second micro-batch lie there
    assert _trips(spark, out) == [0, 1, 2]
    _ingest(spark, src, out, ck)  # the retry
    assert _trips(spark, out) == [0, 1, 2, 3, 4, 5]


def test_a_retried_epoch_lands_once_and_streams_share_a_folder(spark, tmp_dir):
    land = Landing(spark, tmp_dir)
    df = spark.createDataFrame([("1",)], "tripID string")
    assert land.add(df.write.json, "a", 0) and not land.add(df.write.json, "a", 0)
    assert land.add(df.write.json, "b", 0) and land.add(df.write.json, "a", 1)
    assert len(land.folders()) == 3 and readers.read_raw_jsonl(spark, tmp_dir).count() == 3


def test_commits_roll_up(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(Landing, "ROLL", 4)
    land = Landing(spark, tmp_dir)
    for epoch in range(11):
        land.add(lambda folder: os.makedirs(folder), "a", epoch)
    assert len(land.folders()) == len(set(land.folders())) == 11
    assert max(len(land.log.read(n)["folders"]) for n in land.log.numbers()) == 4


def test_a_complete_result_is_whole_at_any_time(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    with pytest.raises(FileNotFoundError):
        readers.read_current(spark, out)
    land = Landing(spark, out)
    held = []
    for epoch in range(4):
        land.add(spark.range(epoch + 1).write.parquet, "a", epoch, replace=True)
        held.append(readers.read_current(spark, out))
        assert held[-1].count() == epoch + 1
        if epoch:
            assert held[-2].count() == epoch  # the one before can still be read
    assert len(os.listdir(os.path.join(out, "data"))) == 2


def test_plain_folders_are_read_as_before(spark, tmp_dir):
    path = os.path.join(tmp_dir, "plain")
    spark.createDataFrame([("7", "1")], "tripID string, deviceID string").write.json(path)
    assert _trips(spark, path) == [7]
