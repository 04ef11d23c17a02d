"""Q8: inspect a raw table - sample, column profile, duplicates, head/tail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates, topk
from ..sources.readers import sample_rows


def inspect(df: DataFrame, sample: int = 1000, k: int = 5, order: list[str] | None = None) -> dict[str, DataFrame]:
    """The inspection views of a table (each a lazy DataFrame)."""
    order = order or df.columns[:1]
    return {
        "sample": sample_rows(df, sample, order),
        "profile": aggregates.profile_columns(df),
        "duplicates": aggregates.duplicate_count(df),
        "head_tail": topk.head_tail(df, k, order),
    }


def inspect_summary(df: DataFrame) -> DataFrame:
    """Whole-table inspection in long form: (metric, position, column_name,
    data_type, value) with the row count, per-column nulls and duplicate
    rows - one shuffle: the rows are grouped once (combined map-side) and
    every figure is a sum over the groups."""
    cols = df.columns
    grouped = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
    totals = grouped.agg(
        F.sum("_n").alias("_rows"),
        F.sum(F.col("_n") - 1).alias("_dups"),
        *[F.coalesce(F.sum(F.when(F.col(f"`{c}`").isNull(), F.col("_n"))), F.lit(0)).alias(f"_n{i}")
          for i, c in enumerate(cols)])
    entries = (["'rows', CAST(NULL AS INT), CAST(NULL AS STRING), CAST(NULL AS STRING), _rows"]
               + [f"'nulls', {i + 1}, '{c}', '{t}', _n{i}" for i, (c, t) in enumerate(df.dtypes)]
               + ["'duplicate_rows', CAST(NULL AS INT), CAST(NULL AS STRING), CAST(NULL AS STRING), "
                  "coalesce(_dups, 0)"])
    return totals.selectExpr(
        f"stack({len(entries)}, {', '.join(entries)}) AS (metric, position, column_name, data_type, value)")
