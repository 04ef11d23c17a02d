"""Token counts against the library on whole texts."""

from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

from fleetspark.llm.token_count import op5_token_counts, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"


def test_odd_texts(spark):
    texts = ["", None, "plain words, with 's and don't  and   spaces  ", " leading", "tabs\tand\nlines\n\n\n", "<|endoftext|>",
             "a<|endoftext|>b <|endoftext|>", "é è ñ ü ß Ünïcödé", "日本語のテキスト", "emoji 🙂🙂 done", "a b c\x1fd\x85e", "\x00\x07",
             "x" * 70_000, "ab " * 20_000, "१२३ ½ ²", "'S 'LL 're''ve", "ﬁ ǆ", "​﻿ zero"]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in enumerate(texts)] + [(None, "no id", 1, "x")] * 2,
                               "doc_id long, text string, n_tokens int, token string")
    got = token_counts(df, PATH, limit=1024).collect()
    tokenizer = Tokenizer.from_file(PATH)
    assert len(got) == len(texts) + 2
    for r in got:
        text = "no id" if r.doc_id is None else texts[r.doc_id] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(text.encode()), n > 1024)
    assert token_counts(df.limit(0), PATH).collect() == []


def test_given_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(PATH)
    want = {d: len(e.ids) for d, e in zip(docs, tokenizer.encode_batch(list(docs.values()), add_special_tokens=False), strict=True)}
    assert {r.doc_id: r.n_tokens for r in op5_token_counts(spark, SMALL).collect()} == want
