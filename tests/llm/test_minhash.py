"""MinHash near-duplicates against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np

from fleetspark.llm.common import Scratch
from fleetspark.llm.components import connected_components
from fleetspark.llm.minhash import near_duplicates
from fleetspark.llm.shingles import shingle_set, similar

SCHEMA = "doc_id long, text string, u string, component string, row string"


def brute(rows: list[tuple]) -> dict[int, tuple[int, int]]:
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def near_copies() -> list[tuple]:
    """Copies of copies, so that a group hangs together over links of its members only."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(12):
        words = [rng.choice(vocabulary) for _ in range(120)]
        for _ in range(rng.choice([1, 2, 9])):
            rows.append((1000 - n, " ".join(words)))
            n += 1
            words = list(words)
            for _ in range(rng.choice([0, 1, 2, 3])):
                words[rng.randrange(120)] = rng.choice(vocabulary)
    return rows


def test_against_all_pairs_and_odd_rows(spark):
    rows = near_copies() + [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, "É a b c d e"),
        (8, "é a b c d e"), (9, "x " * 30_000), (10, "X " * 29_000), (11, "a b c d e f"), (12, "a b c d e f")]
    df = spark.createDataFrame([(d, t, "a", "b", "c") for d, t in rows], SCHEMA)
    got = {r.doc_id: r for r in near_duplicates(df).collect()}
    want = brute(rows)
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
    assert all(r.kept == (d == r.component_id) for d, r in got.items())
    # Small blocks compare the same pairs.
    again = {r.doc_id: r.component_id for r in near_duplicates(df, block=2).collect()}
    assert again == {d: c for d, (_, c) in want.items()}


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (None, "a b c d e f g"), (3, "a b c d e f g"), (9, "z")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (0, 3, False), (3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True)]
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_one_large_group_of_copies(spark):
    """A third of the rows are one text, another third near copies of it."""
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(words)) for i in range(100)]
    rows += [(100 + i, " ".join(words[:i % 70] + ["other"] + words[i % 70 + 1:])) for i in range(100)]
    rows += [(200 + i, " ".join(f"v{i}x{j}" for j in range(20))) for i in range(100)]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: c for d, (_, c) in brute(rows).items()}


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(300, 400)] + [(7000, 7000), (None, 3)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 300 for i in [*range(300, 400), 500]}
    assert connected_components(spark.createDataFrame([], "u long, v long"), Scratch(spark, "t")).collect() == []


def test_threshold_is_inclusive():
    a = np.arange(100, dtype=np.uint64)
    assert similar(a, np.arange(75, dtype=np.uint64), 75) and not similar(a, np.arange(74, dtype=np.uint64), 75)
    assert len(shingle_set("a b c d e a b c d e")) == 5
