"""Shards against a plain rendezvous hash."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import pytest

from fleetspark.llm.sharding import SHARDS, op12_rendezvous_shards, shard_records, write_shards

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def plain(key, weights) -> int:
    name = "" if key is None else str(key)
    times = []
    for n, w in enumerate(weights):
        if w > 0:
            drawn = int(hashlib.md5(f"shard-1:{n}:{name}".encode()).hexdigest()[:13], 16)
            times.append((-math.log((drawn + 0.5) / 16**13) / w, n))
    return min(times)[1]


def check(rows, got, weights, grown):
    assert len(got) == len(rows)
    want = Counter()
    for doc_id, text in rows:
        raw = (text or "").encode()
        want[doc_id, len(raw) + 8, zlib.crc32(raw), "key", plain(doc_id, weights), plain(doc_id, grown)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    by_shard: dict = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r)
    for rs in by_shard.values():
        rs.sort(key=lambda r: r.slot)
        assert [r.slot for r in rs] == list(range(len(rs)))
        order = [(r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in rs]
        assert order == sorted(order)


ODD = ([(i, f"text {i}") for i in range(500)] + [(7, "text 7")] * 40 + [(7, None), (8, ""), (None, None), (None, "x"), (None, "x")]
       + [(2**63 - 1, "é日🙂"), (-2**63, "z" * 300_000)])


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, 1, 2) for r in ODD], SCHEMA + ", shard int, size int").repartition(4)
    weights = (1.0,) * SHARDS
    got = shard_records(df).collect()
    check(ODD, got, weights, weights + (1.0,))
    assert shard_records(df.limit(0)).collect() == []
    assert all(r.grown_shard in (r.shard, SHARDS) for r in got)


def test_weights(spark):
    rows = [(i, "t") for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    weights, grown = (1.0, 0.0, 2.0, 3.0), (1.0, 0.0, 4.0, 3.0)
    got = shard_records(df, weights, grown).collect()
    check(rows, got, weights, grown)
    n = Counter(r.shard for r in got)
    assert set(n) == {0, 2, 3} and abs(n[2] - 2000) < 200 and abs(n[3] - 3000) < 200
    assert {r.grown_shard for r in got if r.grown_shard != r.shard} == {2}
    with pytest.raises(ValueError):
        shard_records(df, (0.0, 0.0))


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = op12_rendezvous_shards(spark, SMALL).collect()
    check(rows, got, (1.0,) * SHARDS, (1.0,) * (SHARDS + 1))


def test_files(spark, tmp_dir):
    rows = [(i % 300, f"text {i}") for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    write_shards(df, f"{tmp_dir}/out", (1.0, 2.0))
    back = spark.read.parquet(f"{tmp_dir}/out").collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted(rows)
    assert all(r.shard == plain(r.doc_id, (1.0, 2.0)) for r in back)
