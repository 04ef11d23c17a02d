"""Vectors of an embedding table: which take part, as bytes; bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import column_names


def usable_vectors(df: DataFrame) -> DataFrame:
    """vec_id, embedding (array<double>) and ``usable``: neither null, empty nor
    zero, and every component finite. One row per vec_id (of rows that share
    one, the least vector); null ids are left out."""
    one = (column_names(df, "vec_id", "embedding").where("vec_id is not null")
           .select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
           .groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    infinite = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return one.withColumn("usable", F.coalesce(F.col("embedding").isNotNull() & ~infinite
                                               & F.exists("embedding", lambda x: x != 0), F.lit(False)))


def matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in vectors], np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares cannot overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sample(df: DataFrame, count: int, rows: int) -> list:
    """About ``rows`` rows of ``df`` (of ``count``), the same in every run,
    chosen by a hash of ``vec_id``; never more than twice as many."""
    every = max(1, count // rows)
    return sorted(df.where(F.pmod(F.xxhash64("vec_id"), F.lit(every)) == 0).limit(2 * rows).collect(), key=lambda r: r.vec_id)
