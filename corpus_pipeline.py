"""Corpus pipeline over ``documents``: five stages, each a dealt operator whose
decisions take effect on the rows. Each stage's result is written and read
again as the next stage's documents; all but the last return the columns of
documents (further columns are carried along).

Decisions fall on rows, not on ids: different texts of one doc_id, and texts
without one, are judged and grouped each for itself.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.common import Scratch, is_empty, table
from fleetspark.llm.minhash import near_duplicates
from fleetspark.llm.mixing import take_mix
from fleetspark.llm.pieces import MODEL, encode_pieces
from fleetspark.llm.pii import mask_personal_data
from fleetspark.llm.quality import quality_scores


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go (9). Rows of equal
    doc_id, text, source and language are judged alike."""
    named = docs.withColumn("text_key", F.md5("text"))
    gone = (quality_scores(named, table(spark, sf_dir, "labels"), carry=("text_key",)).where(~F.col("keep"))
            .select(F.col("doc_id").alias("a"), F.col("text_key").alias("b"), F.col("site").alias("c"), F.col("section").alias("d")).distinct())
    same = [x.eqNullSafe(y) for x, y in zip((docs["doc_id"], F.md5(docs["text"]), docs["source"], docs["lang"]), map(F.col, "abcd"), strict=True)]
    return docs.join(gone, same[0] & same[1] & same[2] & same[3], "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, that of the least doc_id
    (10); null ids come after all others, equal ids go by the text's digest.
    Of rows with equal doc_id and text one stays."""
    if is_empty(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")):
        gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"))
        return docs.join(gone, docs["doc_id"] == F.col("gone_id"), "left_anti")
    # ids repeat or are missing: each different (doc_id, text) gets a number of its own, in their order
    scratch = Scratch(spark, "pipeline-ids")
    named = docs.withColumn("text_key", F.md5("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_key")]
    numbered = scratch.save(
        named.dropDuplicates(["doc_id", "text_key"]).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("number", F.monotonically_increasing_id()))
    kept = near_duplicates(numbered.select(F.col("number").alias("doc_id"), "text")).where("kept").select(F.col("doc_id").alias("kept_number"))
    return numbered.join(kept, numbered["number"] == F.col("kept_number"), "left_semi").select(docs.columns)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind in angle brackets (6)."""
    return mask_personal_data(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights: documents beyond a source's
    budget go, those of repeated epochs come again (1)."""
    return take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as piece ids that decode to it again (8)."""
    return encode_pieces(docs, public_tokenizers.path(MODEL), keep=("source", "lang"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_filter),
    ("MinHash near-dedup", near_dedup),
    ("PII", private_data),
    ("mixing sources", mix),
    ("SentencePiece encoding", encode),
]

#: SQL cannot express the fitted classifier, the similarity join and the piece
#: ids; tests/llm holds the stages against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; intermediate tables lie in the cluster's
    shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
