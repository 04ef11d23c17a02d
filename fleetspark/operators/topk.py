"""Ordering helpers (T3, T4, T5 lives in functions.scores)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_by_device(df: DataFrame) -> DataFrame:
    """Rows in device order (global sort: range partitioning, no single task)."""
    return df.orderBy(F.col("deviceID").asc())


def head_tail(df: DataFrame, k: int = 5, order: Sequence[Column | str] = ("deviceID",)) -> DataFrame:
    """T4: first and last ``k`` rows by ``order`` with a ``side`` tag.

    Each side is a per-task top-k merged on the driver side of the plan
    (TakeOrderedAndProject), never a full sort."""
    asc = [F.col(c).asc() if isinstance(c, str) else c for c in order]
    desc = [F.col(c).desc() if isinstance(c, str) else c.desc() for c in order]
    head = df.orderBy(*asc).limit(k).withColumn("side", F.lit("head"))
    tail = df.orderBy(*desc).limit(k).withColumn("side", F.lit("tail"))
    return head.unionByName(tail)
