"""Mixing against a plain version, and against its SQL."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest

from fleetspark.llm.mixing import OP1_SQL, mix_sources, op1_mix_sources, take_mix

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, target string, rank int, `before` int"


def plain(rows: list[tuple], weights=(5, 2, 1), most=3) -> dict:
    size = {(d, s): len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, s in rows}
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = {s: sum(v for (_, x), v in size.items() if x == s) for s in names}
    stopped: set = set()
    while True:
        free = sum(weight[s] for s in names if s not in stopped)
        share = (sum(total.values()) - sum(most * total[s] for s in stopped)) / free if free else 0
        new = {s for s in names if share * weight[s] > most * total[s]}
        if new <= stopped:
            break
        stopped |= new
    target = {s: float(most * total[s]) if s in stopped else share * weight[s] for s in names}
    taken = {}
    for s in names:
        budget = int(target[s] + 0.5)
        before = 0
        passes, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        for d, v in sorted(((d, v) for (d, x), v in size.items() if x == s),
                           key=lambda k: (hashlib.md5(f"mix-1:{k[0]}".encode()).hexdigest(), k[0])):
            taken[d, s] = passes * v + max(0, min(v, rest - before))
            before += v
    return {k: (size[k], total[k[1]], target[k[1]], taken[k]) for k in size}


def rows_of_three_sources() -> list[tuple]:
    rows = [(i, " ".join(["w"] * (i % 17)), ["a", "b", None, "é", "z"][i % 5 if i % 3 else 0]) for i in range(120)]
    return rows + [(500, None, "a"), (501, "", "only empty"), (502, "x " * 5000, "b")]


def test_against_the_plain_version(spark):
    rows = rows_of_three_sources()
    df = spark.createDataFrame([(d, t, "en", s, 0, "x", 1, 2) for d, t, s in rows], SCHEMA)
    got = {(r.doc_id, r.source): (r["size"], r.source_size, r.target, r.taken) for r in mix_sources(df).collect()}
    want = plain(rows)
    assert {k: (v[0], v[1], v[3]) for k, v in got.items()} == {k: (v[0], v[1], v[3]) for k, v in want.items()}
    assert all(got[k][2] == pytest.approx(want[k][2]) for k in want)
    assert all(t <= 3 * s for s, _, _, t in got.values())
    for source in {k[1] for k in got}:
        own = [v for k, v in got.items() if k[1] == source]
        assert abs(sum(v[3] for v in own) - own[0][2]) <= 1


def test_sql_on_the_given_tables(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = {r[0]: r for r in duck.execute(f"SELECT doc_id, source, size, source_size, target, taken FROM ({OP1_SQL})").fetchall()}
    got = {r.doc_id: tuple(r) for r in op1_mix_sources(spark, SMALL).collect()}
    assert got == want


def test_taken_rows_hold_the_taken_words(spark):
    rows = rows_of_three_sources()
    df = spark.createDataFrame([(d, t, "en", s, len(t or ""), "x", 1, 2) for d, t, s in rows], SCHEMA)
    out = take_mix(df)
    assert out.columns == df.columns
    words: dict = {}
    texts = {d: t for d, t, _ in rows}
    for r in out.collect():
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {d: v[3] for (d, _), v in plain(rows).items() if v[3]}


def test_empty_null_and_repeated(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix_sources(empty).collect() == [] and take_mix(empty).collect() == []
    wordless = spark.createDataFrame([(1, None, None, None, None, None, None, None), (None, " ", None, "s", 1, None, 1, 1)], SCHEMA)
    assert [(r["size"], r.taken, r.target) for r in mix_sources(wordless).collect()] == [(0, 0, 0.0)] * 2
    same = spark.createDataFrame([(1, "a b c", "en", "s", 5, "", 1, 1)] * 4 + [(None, "d e", "en", "s", 3, "", 1, 1)], SCHEMA)
    assert sorted((r["size"], r.taken) for r in mix_sources(same).collect()) == [(2, 2)] + [(3, 3)] * 4
    assert take_mix(same).count() == 5
