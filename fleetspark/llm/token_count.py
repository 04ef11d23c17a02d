"""Token counts by a two-tier lookup on the map side.

Tier one is a broadcast table of the corpus's most frequent pre-tokens and
their lengths in tokens (at most TABLE entries). Tier two is each worker's
cache, which encodes what tier one misses. No pre-token of a text is shuffled:
to choose the table, each task counts its own pre-tokens over all its texts
and hands on its TASK most frequent ones only. The table decides speed, never
a count."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.common import column_names, map_rows, small_batches, table
from fleetspark.llm.pretokens import fill, pre_tokens

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
TABLE = 16_384
TASK = 4_096
COUNTED = 400_000

_known: dict[str, dict[str, int]] = {}


def frequent_lengths(docs: DataFrame, path: str, size: int = TABLE, per_task: int = TASK) -> dict[str, int]:
    """Lengths of about the ``size`` most frequent pre-tokens of all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(pre_tokens(path).of(text or "") or ())
            if len(seen) > COUNTED:
                seen = Counter(dict(seen.most_common(COUNTED // 2)))
        top = seen.most_common(per_task)
        yield pa.RecordBatch.from_pydict({"token": pa.array([t for t, _ in top], pa.string()),
                                          "n": pa.array([n for _, n in top], pa.int64())})

    small_batches(docs.sparkSession)
    top = (docs.select("text").mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "token").limit(size).collect())
    tokens = [r.token for r in top]
    return dict(zip(tokens, map(len, pre_tokens(path).ids(tokens)), strict=True))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``), one
    row per row of ``docs`` (doc_id, text), a null text being empty. ``path``
    names a tokenizers JSON file present on all workers. Nothing is truncated;
    strings of added tokens count as the library counts them. Null ids and
    repeated rows come back as they are, further columns are ignored."""
    spark = docs.sparkSession
    texts = column_names(docs, "doc_id", "text")
    frequent = spark.sparkContext.broadcast(frequent_lengths(texts, path))

    def lengths(asked: list[str]) -> list[int]:
        return [len(x) for x in pre_tokens(path).ids(asked)]

    def count(cols: dict[str, list]) -> dict[str, list]:
        known = _known.setdefault(path, dict(frequent.value))
        plain = [t or "" for t in cols["text"]]
        split = [pre_tokens(path).of(t) for t in plain]
        fill(known, frequent.value, set().union(*(s for s in split if s is not None)), lengths)
        whole = iter(lengths([t for t, s in zip(plain, split, strict=True) if s is None]))
        n = [next(whole) if s is None else sum(map(known.__getitem__, s)) for s in split]
        return {"doc_id": cols["doc_id"], "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in plain],
                "n_tokens": n, "over_limit": [x > limit for x in n]}

    return map_rows(texts, count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
