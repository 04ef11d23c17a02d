"""Repeated strings against brute force; runs and loser trees."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from fleetspark.llm import suffix_dedup
from fleetspark.llm.suffix_dedup import op7_suffix_dedup, remove_repeats
from fleetspark.llm.suffix_runs import common, decoded, front_coded, merged

SMALL = "/root/testdata/sf0.001"


def brute(texts: list, length: int) -> list[tuple]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest(), any(gone)))
    return out


def texts_with_repeats() -> list:
    rng = random.Random(11)

    def some(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    passage, other = some(90), some(70)
    texts = [some(rng.randrange(10, 200)) + passage[rng.randrange(30):60 + rng.randrange(30)] + some(rng.randrange(100)) for _ in range(40)]
    texts += [some(50) + other + some(30) + other, other[:41] + some(9), "ab" * 100, "z" * 300, "z" * 39, "z" * 40, None, "", "short"]
    texts += [texts[0]] * 3 + [texts[5] + "x", "x" + texts[5], passage, passage[:40], "é" * 60]
    near = some(400)
    return texts + [near[:k] + "#" + near[k + 1:] for k in (50, 120, 130, 300)]


def test_against_brute_force(spark):
    texts = texts_with_repeats()
    df = spark.createDataFrame([(i, t, 0, "d", "r") for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int, digest string, `row` string")
    want = brute(texts, 40)
    for group in (2048, 3):  # with 3, most beginnings go out as single windows
        got = {r.doc_id: tuple(r)[1:] for r in remove_repeats(df.repartition(5), length=40, stride=16, group=group).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_no_task_gathers_a_large_beginning(spark, monkeypatch):
    rng = random.Random(3)

    def some(n):
        return "".join(rng.choice("abcdefgh") for _ in range(n))

    passage = some(150)
    texts = [some(rng.randrange(60, 90)) + passage + some(rng.randrange(60, 90)) for _ in range(120)]
    texts += [some(50) + texts[0][:45], passage[:60], "z" * 300]
    gathered = suffix_dedup._merge

    def watched(length, stride, *group):
        run, schema = gathered(length, stride, *group)

        def small(key, pdf):
            marks = Counter(k[:8] for b in pdf["block"] for k, _, _, _ in decoded(b))
            assert max(marks.values()) <= 50
            return run(key, pdf)

        return small, schema

    monkeypatch.setattr(suffix_dedup, "_merge", watched)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in remove_repeats(df, length=40, stride=16, group=50).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 40)


def test_null_and_equal_ids_and_empty_table(spark):
    rows = [(1, "a" * 30 + "b" * 30), (1, "c" * 30 + "d" * 30), (None, "a" * 30 + "b" * 30), (None, "q"), (1, "c" * 30 + "d" * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in remove_repeats(df, length=40, stride=16).collect())
    assert got == [(0, 1, 0), (0, 60, 60), (1, 60, 60), (1, 60, 60), (1, 60, 60)]
    assert remove_repeats(df.limit(0)).collect() == []
    assert [r.n_removed for r in remove_repeats(df.where("text = 'q'")).collect()] == [0]


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: tuple(r)[1:] for r in op7_suffix_dedup(spark, SMALL).collect()}
    assert [got[r.doc_id] for r in docs] == brute([r.text for r in docs], 400)


def test_passages_of_over_50_words_go_from_400_bytes_on(spark):
    rng = random.Random(5)

    def some(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for _ in range(n))

    sizes, texts = (394, 399, 400, 401, 600), [some(200)]
    for size in sizes:
        passage = some(150)[:size]
        assert len(passage.split()) > 50
        texts += [f"{some(40)} A{passage}B {some(40)}", f"{some(60)} C{passage}D {some(20)}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in remove_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 400)
    assert [got[i][1] for i in range(len(texts))] == [0] + [n * (n >= 400) for n in sizes for _ in range(2)]


ENTRIES = st.lists(st.tuples(st.binary(max_size=12).map(lambda b: bytes(x % 3 for x in b)), st.binary(max_size=3), st.integers(1, 9)), max_size=25)


@settings(deadline=None, max_examples=200)
@given(st.lists(ENTRIES, min_size=1, max_size=6))
def test_merging_coded_runs(runs):
    runs = [sorted(r) for r in runs]
    out = list(merged([decoded(front_coded(r)) for r in runs]))
    assert [(k, left) for k, _, left, _ in out] == sorted((k, left) for r in runs for k, left, _ in r)
    assert Counter((k, left, n) for k, _, left, n in out) == Counter(e for r in runs for e in r)
    last = b""
    for key, same, _, _ in out:
        assert same == common(last, key) if last or key else same == 0
        last = key


@given(st.binary(max_size=80), st.binary(max_size=80), st.integers(0, 80))
def test_common_prefix(a, b, n):
    a, b = a[:n] + a, a[:n] + b
    want = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    assert common(a, b) == want and common(a, b, want // 2) == want
