"""Fleet-wide ranks.

``row_number`` over an un-partitioned window moves every row to one task, so
ranks are distributed at every size: range-partition on the sort key, number
rows inside each partition with ``monotonically_increasing_id`` (which encodes
partition id and position), and add a per-partition offset from a prefix sum
over one row per partition (a table whose size is the partition count, so
broadcasting it is safe). The partition count follows the row count, which
the checkpoint of the input counts in passing. The range-partitioned frame is
checkpointed to the shared folder too, so partition ids stay fixed if a task
is re-run after an executor loss.

The sort key must be a total order (the device id is always the last key),
so ranks are a permutation 1..n and reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_with_count, reliable_checkpoint

ROWS_PER_PARTITION = 500_000
_PART_BITS = 33  # monotonically_increasing_id = partition id << 33 | position


def _numbered(df: DataFrame, order: Sequence[Column], out: str,
              rows_per_partition: int) -> tuple[DataFrame, int]:
    """``df`` plus ``out`` (1-based position, long) and ``_pid``; the row count."""
    base, n = checkpoint_with_count(df)
    parts = max(2, -(-n // rows_per_partition))
    ordered = reliable_checkpoint(base.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                                      .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = (ordered.withColumn("_pid", F.shiftright("_mid", _PART_BITS))
                      .withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid"), _PART_BITS)))
    # One row per partition: bounded by the partition count, safe to broadcast.
    offsets = (ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
                      .withColumn("_off", F.coalesce(
                          F.sum("_cnt").over(Window.orderBy("_pid")
                                             .rowsBetween(Window.unboundedPreceding, -1)),
                          F.lit(0)))
                      .select("_pid", "_off"))
    ranked = ordered.join(F.broadcast(offsets), "_pid")
    return ranked.withColumn(out, F.col("_off") + F.col("_pos") + 1).drop("_mid", "_pos", "_off"), n


def global_row_number(df: DataFrame, order: Sequence[Column], out: str,
                      rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` over the whole frame."""
    ranked, _ = _numbered(df, order, out, rows_per_partition)
    return ranked.withColumn(out, F.col(out).cast("int")).drop("_pid").select(*df.columns, out)


def driver_rank(df: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Best safety score first; device id breaks ties."""
    order = [F.col("driver_safety_score").desc_nulls_last(), F.col("deviceID").asc()]
    return global_row_number(df, order, "driver_rank", rows_per_partition)


def risk_rank(df: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Worst health score first; device id breaks ties."""
    order = [F.col("vehicle_health_score").asc_nulls_last(), F.col("deviceID").asc()]
    return global_row_number(df, order, "risk_rank", rows_per_partition)


def percentile_safety_score(df: DataFrame, rate_col: str = "events_per_100_readings", key: str = "deviceID",
                            rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Documented relative scoring - percent rank of the event rate in the
    fleet (highest rate 0, lowest 100), ties sharing the best position.

    A rate's best position is found inside each range partition; only a
    partition's first and last rate can go on in its neighbours, so two rows
    per partition (a table safe to broadcast) settle those. However many
    devices share a rate, no step gathers them."""
    order = [F.col(rate_col).desc_nulls_last(), F.col(key).asc()]
    numbered, n = _numbered(df, order, "_rn", rows_per_partition)
    inside = numbered.withColumn("_best", F.min("_rn").over(Window.partitionBy("_pid", rate_col)))
    by_rate = numbered.groupBy("_pid", F.col(rate_col).alias("_r")).agg(F.min("_rn").alias("_rn"))
    ends = by_rate.groupBy("_pid").agg(F.min_by(F.struct("_r", "_rn"), "_rn").alias("a"),
                                       F.max_by(F.struct("_r", "_rn"), "_rn").alias("b"))
    edges = (ends.select(F.explode(F.array("a", "b")).alias("e")).groupBy(F.col("e._r").alias("_r"))
                 .agg(F.min("e._rn").alias("_edge")))
    joined = inside.join(F.broadcast(edges), F.col(rate_col).eqNullSafe(F.col("_r")), "left")
    rank = F.coalesce("_edge", "_best")
    score = F.when(F.lit(n) > 1, (rank - 1) / F.lit(max(n - 1, 1))).otherwise(F.lit(0.0)) * 100
    return joined.select(*df.columns, score.cast("double").alias("percentile_safety_score"))
