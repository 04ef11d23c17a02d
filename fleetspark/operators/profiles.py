"""Column profiles from mergeable sketches (A12 in one pass, over batches).

One scan of a batch gives, for each column, exact counts and three sketches:
distinct values (HyperLogLog), quantiles of numbers and times (KLL) and
frequent values. They are a row a column, can be stored with the batch, and
merge over batches, so that a table's profile reads no history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of HyperLogLog's registers (standard error 1.04 / 2 ** (LOG_K / 2)), size of a quantile sketch
#: (rank error some 1.33 / K ** 0.9 at 99 %), values tracked for the frequent ones (a value with more
#: than rows / TRACKED * 4 / 3 occurrences is never missed).
LOG_K, K, TRACKED = 12, 800, 3000
SHARES = (0.01, 0.25, 0.5, 0.75, 0.99)
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def profile_state(df: DataFrame) -> DataFrame:
    """One row per column of ``df``: position, column_name, data_type, rows,
    nulls (NaN is no null), distinct, quantiles (null for texts) and frequent
    sketches. One scan, no exchange but that of the partial results."""
    aggregates, stack = [F.count(F.lit(1)).alias("_rows")], []
    for i, (name, kind) in enumerate(df.dtypes):
        quoted = f"`{name}`"
        text = f"cast({quoted} as string)"
        number = (f"cast({quoted} as double)" if kind in NUMBERS or kind.startswith("decimal") else
                  f"cast(unix_micros(cast({quoted} as timestamp)) as double)" if kind.startswith(("timestamp", "date")) else None)
        aggregates += [
            F.count_if(F.col(quoted).isNull()).alias(f"_n{i}"),
            F.expr(f"hll_sketch_agg({text}, {LOG_K})").alias(f"_d{i}"),
            F.expr(f"kll_sketch_agg_double({number}, {K})" if number else "cast(null as binary)").alias(f"_q{i}"),
            F.expr(f"approx_top_k_accumulate({text}, {TRACKED}) FILTER (WHERE {quoted} IS NOT NULL)").alias(f"_t{i}")]
        shown = name.replace("'", "\\'")
        stack.append(f"{i + 1}, '{shown}', '{kind}', _n{i}, _d{i}, _q{i}, _t{i}")
    return df.agg(*aggregates).selectExpr(
        "_rows AS rows", f"stack({len(stack)}, {', '.join(stack)}) AS (position, column_name, data_type, nulls, distinct, quantiles, frequent)")


def merge_states(states: DataFrame) -> DataFrame:
    """The states of several batches (their union) as those of one table."""
    return states.groupBy("position", "column_name", "data_type").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.expr("hll_union_agg(distinct)").alias("distinct"),
        F.expr("kll_merge_agg_double(quantiles)").alias("quantiles"), F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"))


def profile_report(state: DataFrame, shares: Sequence[float] = SHARES, top: int = 5) -> DataFrame:
    """position, column_name, data_type, rows, nulls, distinct_values (about),
    quantiles (about, at ``shares``; times in microseconds; null without
    numbers) and frequent (value, count; the most frequent first)."""
    n = F.when(F.col("quantiles").isNotNull(), F.kll_sketch_get_n_double("quantiles"))
    asked = F.array(*[F.kll_sketch_get_quantile_double("quantiles", F.lit(float(s))) for s in shares])
    return state.select(
        "position", "column_name", "data_type", "rows", "nulls", F.hll_sketch_estimate("distinct").alias("distinct_values"),
        F.when(n > 0, asked).alias("quantiles"),
        F.expr(f"transform(approx_top_k_estimate(frequent, {top}), x -> named_struct('value', x.item, 'count', x.count))").alias("frequent"))
