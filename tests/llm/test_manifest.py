"""The manifest against a plain tree over sorted rows."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from fleetspark.llm.manifest import Forest, fold, merkle_manifest, op11_merkle_manifest, place_leaves
from fleetspark.llm.common import Scratch
from fleetspark.llm.queries import SQL

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r: dict, tampered: bool = False) -> str:
    out = ""
    for c in ("doc_id", "source", "lang", "n_chars", "text"):
        v = r[c]
        if c == "text" and tampered and v is not None:
            v = v.translate(LOWER)
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def tree(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def steps(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    out = []
    for nodes in levels[:-1]:
        run = i // 8 * 8
        out.append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 8])))
        i //= 8
    return out


def plain(rows: list[dict]) -> list[tuple]:
    by_lang: dict = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in by_lang[lang]])
    top = tree([trees[x][-1][0] for x in langs])
    root = top[-1][0] if langs else None
    out = []
    for k, lang in enumerate(langs):
        for i, r in enumerate(by_lang[lang]):
            path = steps(trees[lang], i) + steps(top, k)
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            node = leaf(r, tampered)
            for a, b in path:
                node = sha(a + node + b)
            out.append((r["doc_id"], leaf(r), trees[lang][-1][0], root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def query(df):
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered).otherwise(F.col("text"))}


def found(df, **how) -> list[tuple]:
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in names) for r in merkle_manifest(df, query(df), **how).collect()), key=repr)


def row(doc_id, text="Some Text", lang="en", source="web", n_chars=9) -> dict:
    return {"doc_id": doc_id, "text": text, "lang": lang, "source": source, "n_chars": n_chars}


ODD = ([row(i, f"Text {i}", "en") for i in range(0, 1500, 7)]
       + [row(i * 10**15 - 5 * 10**17, f"Wide {i}", "de") for i in range(100)]
       + [row(9), row(9), row(9, "other"), row(9, None), row(9, "")]
       + [row(None, "no id"), row(None, "no id"), row(None, None, None, None, None)]
       + [row(1, "lone", "fr")] + [row(k, "É ß 日本 🙂 ABC", None) for k in range(9)]
       + [row(2**63 - 1, "last"), row(-2**63, "first"), row(-1, "minus"), row(63), row(64), row(127)]
       + [row(5, "x Y " * 20_000, "é")] + [row(77, "Same", "hot") for _ in range(300)])


@pytest.mark.parametrize("levels, copies", [(4, 65_536), (1, 64), (2, 7)])
def test_odd_rows(spark, levels, copies):
    df = spark.createDataFrame([tuple(r.values()) + ("x", 3) for r in ODD], SCHEMA + ", leaf string, pos long").repartition(5)
    assert found(df, levels=levels, copies=copies) == plain(ODD)


def test_one_row_and_none(spark):
    one = [row(3, "A")]
    df = spark.createDataFrame([tuple(r.values()) for r in one], SCHEMA)
    got = found(df)
    assert got == plain(one)
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == sha("")
    assert merkle_manifest(df.limit(0)).collect() == []


def test_given_documents(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = op11_merkle_manifest(spark, SMALL)
    assert sorted((tuple(r)[:7] for r in got.collect()), key=repr) == plain(rows)
    assert "op11_merkle_manifest" in SQL


def test_paths_verify_other_contents(spark):
    df = spark.createDataFrame([tuple(row(i, f"T{i}").values()) for i in range(70)], SCHEMA)
    for r in merkle_manifest(df, levels=1).collect():
        assert r.verified and fold(r.leaf, r.path) == r.root != fold(sha("other"), r.path)


def test_places_need_no_dense_keys(spark):
    """Directories of several levels, negative and far apart keys."""
    keys = sorted({(i * 2654435761) % 2**62 * (-1) ** i for i in range(3000)} | set(range(-70, 70)))
    df = spark.createDataFrame([("t", k, sha(str(k)), None) for k in keys], "tree string, key long, leaf string, claim string")
    got = {r.key: r.pos for r in place_leaves(df.repartition(7), Scratch(spark, "t")).collect()}
    assert got == {k: i for i, k in enumerate(keys)}


def test_gaps_stop_the_job(spark):
    df = spark.createDataFrame([("t", 0, "a"), ("t", 2, "b")], "tree string, pos long, digest string")
    with pytest.raises(Exception, match="gapless|out of range"):
        Forest(df, Scratch(spark, "t"))
