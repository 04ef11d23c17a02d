"""Embedding near-dedup and neighbours against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from fleetspark.llm.embed_dedup import near_duplicate_vectors
from fleetspark.llm.neighbours import nearest, op4_nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, n int, code string, score double"
ODD = [(9001, None), (9002, [0.0] * 8), (9003, [float("nan")] + [1.0] * 7), (9004, [None] + [1.0] * 7), (9005, [float("inf")] + [1.0] * 7),
       (9006, []), (9007, [1.0, 2.0]), (9008, [2.0, 4.0]), (None, [1.0] * 8), (9009, [1e38] * 8), (9010, [1e-38] * 8)]


def groups(seed: int = 4) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for size in [1] * 150 + [2] * 10 + [60, 200]:
        centre = rng.standard_normal(8)
        for _ in range(size):
            rows.append((n, (centre + rng.standard_normal(8) * 0.1).tolist()))
            n += 1
    return rows + [(n + i, rows[3][1]) for i in range(5)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "c", 0.5) for i, v in rows], SCHEMA)


def unit_rows(rows):
    x = np.array([v for _, v in rows], np.float32).astype(float)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_near_duplicates_against_all_pairs(spark):
    rows = groups()
    x = unit_rows(rows)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    part = list(range(len(rows)))

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = find(i), find(j)
        part[max(a, b)] = min(a, b)
    df = frame(spark, rows + ODD)
    for settings in ({}, {"leaf": 64, "spill": 0.2, "trees": 24, "block": 16}):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(df, **settings).collect()}
        assert len(got) == len(rows) + len(ODD) - 1
        assert all(got[i] == (linked[i].sum(), find(i), find(i) == i) for i in range(len(rows)))
        assert all(got[i] == (0, i, True) for i in range(9001, 9007))
        assert got[9008] == (1, 9007, False) and got[9010][1] == 9009
    assert near_duplicate_vectors(df.limit(0)).collect() == []


def test_neighbours_are_exact_on_small_tables(spark):
    rows = groups()
    x = unit_rows(rows)
    df = frame(spark, rows + ODD[:8] + [rows[7]])
    got: dict = {}
    for r in nearest(df, F.pmod("vec_id", F.lit(50)) == 0, shard=100, block=3).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert sorted(got) == [i for i, _ in rows if i % 50 == 0]
    for q, found in got.items():
        score = x @ x[q]
        score[q] = -2
        order = np.lexsort((np.arange(len(rows)), -score.round(12)))[:5]
        assert [found[k][0] for k in range(1, 6)] == order.tolist()
        assert np.allclose([found[k][1] for k in range(1, 6)], score[order])
    assert nearest(df.limit(0), F.lit(True)).collect() == []
    assert nearest(df.where("vec_id = 0"), F.lit(True)).collect() == []


def test_recall_on_given_embeddings(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()]
    x = unit_rows(rows)
    found: dict = {}
    for r in op4_nearest_neighbours(spark, sf_dir).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for k, (i, _) in enumerate(rows):
        if i % 50 == 0:
            score = x @ x[k]
            score[k] = -2
            hits += len({rows[j][0] for j in np.argsort(-score)[:5]} & found[i])
            total += 5
    assert hits / total >= 0.95


def hot_group(count: int, size: int, seed: int = 1):
    """``count`` vectors of which every third or so, ``size`` in all, is of one
    group with different vectors at a cosine of about 0.97 to each other."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((count, 64))
    centre = rng.standard_normal(64)
    within = rng.permutation(count)[:size]
    x[within] = centre / np.linalg.norm(centre) + rng.standard_normal((size, 64)) * 0.175 / 8
    return [(i, v) for i, v in enumerate(x.tolist())], within


def test_links_of_a_dense_group_are_all_found(spark):
    rows, within = hot_group(12_000, 4_000)
    near = [(20_000 + i, (np.array(rows[int(k)][1]) * 1.0 + 0.02).tolist()) for i, k in enumerate(within[:50])]
    rows += near
    x = unit_rows(rows)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    want = dict(zip([i for i, _ in rows], linked.sum(axis=1).tolist(), strict=True))
    got = {r.vec_id: r for r in near_duplicate_vectors(frame(spark, rows)).collect()}
    assert {i: r.n_links for i, r in got.items()} == want
    assert linked.sum() > 10_000_000 and {got[int(i)].component_id for i in within} == {int(min(within))}


def test_recall_beside_a_dense_group(spark):
    rows, within = hot_group(6_000, 2_000)
    x = unit_rows(rows)
    found: dict = {}
    for r in nearest(frame(spark, rows), F.pmod("vec_id", F.lit(50)) == 0, at_least=1, shard=2_000).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits: dict = {True: [], False: []}
    inside = set(within.tolist())
    for q, got in found.items():
        score = x @ x[q]
        score[q] = -2
        hits[q in inside].append(len(set(np.argsort(-score)[:5].tolist()) & got) / 5)
    assert len(found) == 120 and np.mean(hits[True]) >= 0.9 and np.mean(hits[False]) >= 0.9


def test_recall_in_many_dimensions_without_structure(spark):
    """256 dimensions, nothing near anything: the measured share keeps the recall."""
    x = np.random.default_rng(3).standard_normal((4_000, 256)).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    x = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    found: dict = {}
    for r in nearest(df, F.pmod("vec_id", F.lit(10)) == 0, at_least=1, shard=2_000).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q, got in found.items():
        score = x @ x[q]
        score[q] = -2
        hits.append(len(set(np.argsort(-score)[:5].tolist()) & got) / 5)
    assert len(found) == 400 and np.mean(hits) >= 0.9
    exact = {(r.query_id, r.vec_id) for r in nearest(df.where("vec_id < 1000"), F.col("vec_id") == 0, share=1.0).collect()}
    score = x[:1000] @ x[0]
    score[0] = -2
    assert exact == {(0, int(j)) for j in np.argsort(-score)[:5]}
