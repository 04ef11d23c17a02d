"""Packed rows: lossless, tight, and best fit as a plain version does it."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetspark.llm.packing import ROW, best_fit, op2_token_packing, pack_documents, unpack

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_decreasing(lengths):
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - n)
        else:
            rooms.append(50 - n)
    rows = best_fit(lengths, 50)
    assert sorted(k for row in rows for k in row) == list(range(len(lengths)))
    assert sorted(50 - sum(lengths[k] for k in row) for row in rows) == sorted(rooms)


def test_documents_come_back(spark):
    texts = {1: "hello world. " * 300, 2: "short", 3: None, 4: "", 5: "日本語 and <|endoftext|> in a text", 6: "short", 7: "x" * 9000}
    rows = [(d, t, 0, "p") for d, t in texts.items()] + [(None, "no id", 0, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, pack_id string")
    got: dict = defaultdict(dict)
    for window in (64, 1 << 20):
        got.clear()
        for r in pack_documents(df, PATH, row=64, window=window).collect():
            r = r.asDict()
            assert r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] <= 64
            ids, positions = np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["positions"], "<u2")
            assert len(ids) == len(positions) == 64 and not ids[r["n_tokens"]:].any()
            for (doc, start, piece), a in zip(unpack(r), r["cu_seqlens"], strict=False):
                got[doc][start] = piece.tolist()
                assert positions[a:a + len(piece)].tolist() == list(range(len(piece)))
        tokenizer = Tokenizer.from_file(PATH)
        back = {d: [x for s in sorted(p) for x in p[s]] for d, p in got.items()}
        want = {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in [*texts.items(), (None, "no id")] if t}
        assert back == want
    assert pack_documents(df.limit(0), PATH).collect() == []


def test_query_is_lossless_and_as_tight_as_a_plain_best_fit(spark):
    """At production settings: one file is one window."""
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(PATH)
    want = {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in docs.items() if t}
    want = {d: ids for d, ids in want.items() if ids}
    rows = [r.asDict() for r in op2_token_packing(spark, "/root/testdata/sf0.001").collect()]
    got: dict = defaultdict(dict)
    for r in rows:
        for doc, start, piece in unpack(r):
            assert start not in got[doc]
            got[doc][start] = piece.tolist()
    assert {d: [x for s in sorted(p) for x in p[s]] for d, p in got.items()} == want
    rooms: list[int] = []
    pieces = [n for ids in want.values() for n in [ROW] * (len(ids) // ROW) + [len(ids) % ROW] * (len(ids) % ROW > 0)]
    for n in sorted(pieces, reverse=True):
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms.remove(min(fitting))
        rooms.append(min(fitting) - n if fitting else ROW - n)
    assert sorted(ROW - r["n_tokens"] for r in rows) == sorted(rooms)
