"""Previous reading within a trip.

A plain ``lag`` over ``Window.partitionBy(tripID, deviceID)`` sends a whole
trip to one task, so one very long trip (or one device holding a third of
the data) becomes a straggler. Here the window is salted by a time bucket of
the reading: ``lag`` runs inside (trip, device, bucket) groups, and the first
reading of each bucket takes the last reading of the previous non-empty
bucket of its trip from a small per-bucket table (one row per bucket). The
result equals the unsalted ``lag`` exactly, null keys included. The readings
are scanned, shuffled and sorted once: the per-bucket table comes from the
same exchange, and the join is on the columns the exchange is partitioned by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS, Thresholds
from ..schema import READING_TIEBREAK, TRIP_KEYS


def _order_cols(df: DataFrame, ts: str, tiebreak: Sequence[str] | None) -> list[str]:
    tb = READING_TIEBREAK if tiebreak is None else tiebreak
    return [ts] + [c for c in tb if c in df.columns and c != ts]


def with_previous(df: DataFrame, value_cols: Sequence[str], keys: Sequence[str] = TRIP_KEYS,
                  ts: str = "timeStamp", tiebreak: Sequence[str] | None = None,
                  bucket_seconds: int | None = DEFAULTS.lag_bucket_seconds,
                  prefix: str = "prev_", start_col: str | None = None) -> DataFrame:
    """Add ``prev_<c>`` = value of ``c`` on the previous reading of the same
    trip (ordered by timestamp, then the remaining typed columns); with
    ``start_col`` also whether a reading is the first of its trip."""
    keys = list(keys)
    order = _order_cols(df, ts, tiebreak)
    if not bucket_seconds:
        w = Window.partitionBy(*keys).orderBy(*order)
        starts = {start_col: F.row_number().over(w) == 1} if start_col else {}
        return df.withColumns({f"{prefix}{c}": F.lag(c).over(w) for c in value_cols} | starts)

    # A struct of the keys is equal to itself where a key is null, as in a
    # window's groups; a missing timestamp is a bucket of its own, the first.
    bucket = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(bucket_seconds * 1_000_000))
    d = df.withColumns({"_key": F.struct(*keys), "_tb": F.coalesce(bucket, F.lit(-(1 << 62)))})
    w = Window.partitionBy("_key", "_tb").orderBy(*order)
    local = d.withColumns({"_pos": F.row_number().over(w),
                           **{f"_lag_{c}": F.lag(c).over(w) for c in value_cols}})

    # The last reading of every bucket, from the same sorted exchange (its row
    # is kept whole, so both branches read the same columns and Spark reuses
    # the exchange), carried to the next bucket of the trip.
    ends = (d.withColumn("_next", F.lead(F.lit(1)).over(w)).filter(F.col("_next").isNull())
             .select("_key", "_tb", F.struct(*df.columns).alias("_row")))
    carry = ends.select("_key", "_tb", F.lag("_row").over(Window.partitionBy("_key").orderBy("_tb")).alias("_carry"))

    joined = local.join(carry, on=["_key", "_tb"], how="left")
    out = joined.withColumns({
        f"{prefix}{c}": F.when(F.col("_pos") == 1, F.col("_carry")[c]).otherwise(F.col(f"_lag_{c}"))
        for c in value_cols
    } | ({start_col: (F.col("_pos") == 1) & F.col("_carry").isNull()} if start_col else {}))
    return out.drop("_key", "_tb", "_pos", "_carry", *[f"_lag_{c}" for c in value_cols])


def with_speed_delta(df: DataFrame, th: Thresholds = DEFAULTS, **kw) -> DataFrame:
    """W1 + W2: prev_speed and speed_delta (null on a trip's first reading)."""
    kw.setdefault("bucket_seconds", th.lag_bucket_seconds)
    out = with_previous(df, ["speed"], **kw)
    return out.withColumn("speed_delta", F.col("speed") - F.col("prev_speed"))


def with_gap_aware_speed_delta(df: DataFrame, max_gap_s: float = 1.0,
                               th: Thresholds = DEFAULTS, **kw) -> DataFrame:
    """Speed delta only where the previous reading is at most
    ``max_gap_s`` seconds earlier (the documented "change in 1 second")."""
    kw.setdefault("bucket_seconds", th.lag_bucket_seconds)
    out = with_previous(df, ["speed", "timeStamp"], **kw)
    gap = (F.unix_micros(F.col("timeStamp").cast("timestamp"))
           - F.unix_micros(F.col("prev_timeStamp").cast("timestamp"))) / F.lit(1_000_000.0)
    return (out.withColumn("gap_seconds", gap)
               .withColumn("speed_delta",
                           F.when(F.col("gap_seconds") <= F.lit(float(max_gap_s)),
                                  F.col("speed") - F.col("prev_speed"))))
