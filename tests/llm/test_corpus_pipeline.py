"""The pipeline's stages one by one, and the registration."""

from __future__ import annotations

import sentencepiece
import public_tokenizers
from test_minhash import brute
from test_pii import plain as plain_spans

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from fleetspark.llm.quality import quality_scores

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_in_turn(spark, tmp_dir):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    before = docs
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_dir}/{n}"
        stage(spark, before, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        old, new = before.collect(), after.collect()
        ids = {r.doc_id for r in new}
        if n < 4:
            assert after.columns == columns, name
        if n == 0:
            keep = {r.doc_id for r in quality_scores(before, spark.read.parquet(f"{SMALL}/labels.parquet")).where("keep").collect()}
            assert ids == keep and 0 < len(keep) < len(old)
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
            assert all((labels[r.doc_id] == 1) == (r.doc_id in ids) for r in old if r.doc_id in labels)
        elif n == 1:
            assert sorted(ids) == sorted({c for _, c in brute([(r.doc_id, r.text) for r in old]).values()}) and len(new) == len(ids)
        elif n == 2:
            texts = {r.doc_id: r.text for r in new}
            for r in old:
                text, at = "", 0
                for kind, a, b in sorted(plain_spans(r.text), key=lambda s: s[1]):
                    if a >= at:
                        text, at = text + r.text[at:a] + f"<{kind.upper()}>", b
                assert texts[r.doc_id] == text + r.text[at:]
        elif n == 3:
            full = {r.doc_id: r.text for r in old}
            assert all(full[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) for r in new)
        else:
            own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
            want = sorted((r.doc_id, own.encode(r.text)) for r in old)
            assert sorted((r.doc_id, list(r.ids)) for r in new) == want and all(r.round_trip for r in new)
        before = after
    again = corpus_pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.n_tokens) for r in again.collect()) == sorted((r.doc_id, r.n_tokens) for r in before.collect())


def test_stages_on_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "w " * 30_000, "en", "s", 60_000), (3, "a@b.c is here", "en", None, 13),
            (3, "a@b.c is here", "en", None, 13), (None, "no id 1.2.3.4", "en", "s", 13)]
    for table in (spark.createDataFrame(rows, DOCS), spark.createDataFrame([], DOCS)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, table, SMALL)
            n = out.count()
            assert n <= max(table.count(), 3 * table.count()) and (k == 4 or out.columns == table.columns)
    stay = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, DOCS), SMALL).collect()
    assert sorted((r.doc_id or 0) for r in stay) == [0, 0, 1, 2, 3]


def test_several_texts_of_one_id(spark):
    """Every group keeps exactly one row, the same in every run."""
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    near, alone = a + " end", " ".join(f"c{i}" for i in range(40))
    rows = [(5, a, "en", "s", 1), (7, near, "en", "s", 1), (3, b, "en", "s", 1), (5, b, "en", "s", 1), (5, b, "en", "s", 1),
            (None, alone, "en", "s", 1), (None, near, "en", "s", 1), (None, None, "en", "s", 1)]
    for order in (rows, rows[::-1]):
        got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(order, DOCS).repartition(3), SMALL).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted([(5, a), (3, b), (None, alone), (None, None)], key=repr)


def test_quality_judges_rows_not_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    judged = {r.doc_id for r in corpus_pipeline.quality_filter(spark, docs, SMALL).select("doc_id").collect()}
    every = {r.doc_id for r in docs.collect()}
    assert judged and every - judged
    good, bad = min(judged), min(every - judged)
    shared = docs.withColumn("doc_id", F.when(F.col("doc_id") == bad, F.lit(good)).otherwise(F.col("doc_id")))
    left = corpus_pipeline.quality_filter(spark, shared, SMALL)
    text = docs.where(F.col("doc_id") == good).first().text
    assert text in [r.text for r in left.where(F.col("doc_id") == good).collect()]


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
