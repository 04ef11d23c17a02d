"""Alignment against plain loops over tokens and bytes."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetspark.llm import alignment as A

SMALL = "/root/testdata/sf0.001"
PATH_A, PATH_B = (public_tokenizers.path(x) for x in (A.TOKENIZER, A.MODEL))
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def spelled(word: str) -> bytes:
    """A byte-level entry's bytes, by the published rule written out again."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, n = {chr(b): b for b in kept}, 0
    for b in range(256):
        if b not in kept:
            table[chr(256 + n)] = b
            n += 1
    return bytes(table[c] for c in word)


def encoded(libraries, text):
    """Ids and byte lengths on both sides, or None."""
    a, b = libraries
    if not text:
        return None
    ai, bi = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ab = [spelled(a.id_to_token(i)) for i in ai]
    bb = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in bi]
    want = (" " + text).encode()
    return (ai, bi, ab, bb) if b"".join(ab) == want == b"".join(bb) else None


def ends(tokens: list[bytes]) -> list[int]:
    out, at = [], 0
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def plain(libraries, rows):
    aligned, count = [], Counter()
    for _, text in rows:
        found = encoded(libraries, text)
        links, groups = [], []
        if found:
            ai, bi, ab, bb = found
            ea, eb = ends(ab), ends(bb)
            both = set(ea) & set(eb)
            last_a, last_b = dict(zip(ea, ai)), dict(zip(eb, bi))
            links = [(last_a[e], last_b[e]) for e in sorted(both)]
            sides = []
            for ids, at in ((ai, ea), (bi, eb)):
                side, run = [], []
                for i, e in zip(ids, at):
                    run.append(str(i))
                    if e in both:
                        side.append(",".join(run))
                        run = []
                sides.append(side)
            groups = ["|".join(x) for x in zip(*sides)]
        count.update(links)
        aligned.append((found, links, groups))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for (doc_id, _), (found, links, groups) in zip(rows, aligned, strict=True):
        text = ";".join(groups)
        out.append((doc_id, len(found[0]) if found else 0, len(found[1]) if found else 0, len(groups), len(links),
                    sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if found else ""))
    return sorted(out, key=repr)


ODD = ["", None, " ", "  ", "   x", "plain words, with 's and don't  and   spaces  ", " leading", "trailing ", "tabs\tand\nlines\n\n\n and \n more",
       "<|endoftext|>", "a<|endoftext|>b", "<s> </s> <unk> <0x41>", "é è ñ ü ß Ünïcödé", "日本語のテキスト 日本", "emoji 🙂🙂 done", "a\x1fb \x85 c\xa0 d",
       "\x00\x07", "x" * 70_000, "ab " * 20_000, "१२३ ½ ²", "mark ▁ in text", "▁", "\u200b\ufeff zero", "\u180e x", "same text twice", "same text twice",
       "\n", " \n ", "a \u3000 b", "é combining", "unbelievable antidisestablishmentarianism"]


@pytest.mark.parametrize("most", [A.FREQUENT, 3, 0])
def test_odd_texts(spark, libraries, most):
    rows = [*enumerate(ODD), (None, "no id"), (None, "no id"), (5, "again five")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_a int, a_ids string").repartition(3)
    got = A.alignment_digest(df, PATH_A, PATH_B, most=most)
    assert tuple(got.columns) == NAMES
    assert sorted(map(tuple, got.collect()), key=repr) == plain(libraries, rows)
    assert A.alignment_digest(df.limit(0), PATH_A, PATH_B, most=most).collect() == []


def test_given_documents(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = A.op13_cross_tokenizer(spark, SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == plain(libraries, rows)


def test_all_links(spark, libraries):
    """Overlap and group links, in order, with their values."""
    texts = ["Internationalisation of naïve cafés 2024-05-06", "日本語 tokens  mixed\n\nlines", "", "▁ not given back"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in A.align_tokenizers(df, PATH_A, PATH_B).collect():
        found = encoded(libraries, texts[r.doc_id])
        if not found:
            assert r.a_ids == r.b_ids == r.a_groups == r.overlap_a == r.group_b == r.end_value == []
            continue
        ai, bi, ab, bb = found
        ea, eb = ends(ab), ends(bb)
        both = sorted(set(ea) & set(eb))
        place = lambda e: next(n for n, x in enumerate(both) if e <= x)
        over, group = [], []
        for i, x in enumerate(ea):
            for j, y in enumerate(eb):
                shared = min(x, y) - max(x - len(ab[i]), y - len(bb[j]))
                if shared > 0:
                    over.append((ai[i], bi[j], shared))
                if place(x) == place(y):
                    group.append((ai[i], bi[j], 1))
        assert (r.a_ids, r.b_ids) == (ai, bi)
        assert list(zip(r.overlap_a, r.overlap_b, r.overlap_value)) == over
        assert list(zip(r.group_a, r.group_b, r.group_value)) == group
        assert list(zip(r.end_a, r.end_b)) == [(ai[ea.index(e)], bi[eb.index(e)]) for e in both]
        assert r.a_groups == [sum(place(x) == n for x in ea) for n in range(len(both))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=4, max_size=4), max_size=6), st.integers(1, 5), st.randoms())
def test_product_is_the_matrix_product(rows, n, rnd):
    a = np.array(rows, np.int64).reshape(-1, 4)
    b = np.array([[rnd.randint(0, 2) for _ in range(n)] for _ in range(4)], np.int64)
    sparse = [A.by_rows(*np.nonzero(m), m[np.nonzero(m)], *m.shape) for m in (a, b)]
    got = A.product(*sparse)
    dense = np.zeros((len(a), n), np.int64)
    dense[got.rows(), got.indices] = got.values
    assert (dense == a @ b).all()
    back = A.transposed(A.transposed(sparse[1]))
    assert all((x == y).all() for x, y in zip(back[:3], sparse[1][:3]))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab Z\n\t\u3000\u180e日é'1.🙂"), min_size=1, max_size=30))
def test_segments_change_no_token(text):
    both = A.pair(PATH_A, PATH_B, ("end",))
    assert both.cuts
    parts = both.segments(text)
    assert "".join(parts) == " " + text
    assert [i for p in parts for i in both.a.encode(p, add_special_tokens=False).ids] == both.a.encode(" " + text, add_special_tokens=False).ids
    assert [i for p in parts for i in (both.b.encode(p[1:]) if p != " " else [both.mark])] == both.b.encode(text)
