"""Raw → typed readings (P1-P6) and the cleaning counters (A1).

The order is the original one: exact-duplicate removal on the raw strings
first, then the malformed-row filter, typing, and the null/NaN drop. Casts
use ``try_cast`` / ``try_to_timestamp`` so bad values become null under ANSI
mode instead of failing the job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TIMESTAMP_FORMAT
from ..schema import CRITICAL_COLUMNS, NUMERIC_COLUMNS, RAW_COLUMNS


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop byte-identical full rows (P1). Map-side partial aggregation keeps
    a hot duplicate group from reaching one reducer in full."""
    return df.dropDuplicates()


def valid_trip_id(col: str = "tripID") -> Column:
    """Digits only (Java regex, so a trailing newline also passes)."""
    return F.coalesce(F.col(col).rlike(r"^\d+$"), F.lit(False))


def valid_device_id(col: str = "deviceID") -> Column:
    """Castable to double."""
    return F.col(col).try_cast("double").isNotNull()


def is_well_formed() -> Column:
    return valid_trip_id() & valid_device_id()


def filter_malformed(df: DataFrame) -> DataFrame:
    """Keep rows with a numeric trip and device; removes embedded headers."""
    return df.filter(is_well_formed())


def typed_columns() -> list[Column]:
    """P5 projection: every typed column in one select."""
    cols = [
        F.col("tripID").try_cast("int").alias("tripID"),
        F.col("deviceID").try_cast("double").try_cast("int").alias("deviceID"),
        F.try_to_timestamp(F.col("timeStamp"), F.lit(TIMESTAMP_FORMAT)).alias("timeStamp"),
        F.col("accData").cast("string").alias("accData"),
    ]
    cols += [F.col(c).try_cast("double").alias(c) for c in NUMERIC_COLUMNS]
    return cols


def cast_types(df: DataFrame) -> DataFrame:
    extra = [c for c in df.columns if c not in RAW_COLUMNS]
    return df.select(*typed_columns(), *extra)


def critical_present() -> Column:
    """All critical columns non-null and no NaN in the doubles."""
    conds = [F.col(c).isNotNull() for c in CRITICAL_COLUMNS]
    conds += [~F.isnan(F.col(c)) for c in NUMERIC_COLUMNS]
    return reduce(lambda a, b: a & b, conds)


def drop_null_critical(df: DataFrame) -> DataFrame:
    return df.dropna(subset=CRITICAL_COLUMNS)


def distinct_with_counts(raw: DataFrame) -> DataFrame:
    """Distinct raw rows with their multiplicity (one shuffle, partial agg)."""
    return raw.select(*RAW_COLUMNS).groupBy(*RAW_COLUMNS).agg(F.count(F.lit(1)).alias("_copies"))


def with_quality_flags(counted: DataFrame, copies: str = "_copies") -> DataFrame:
    """Typed columns plus the flags the filter and the counters need, each
    cast evaluated once: ``_ok`` (well formed), ``_keep`` (well formed and
    all critical values present), ``_ref_bad`` (counted as malformed by the
    original counter)."""
    typed = counted.select(
        *typed_columns(), F.col(copies).alias("_copies"),
        is_well_formed().alias("_ok"),
        # The original counter tests ``isNotNull() IS NULL`` (never true), so
        # only bad trip ids are counted, and a null trip id is not counted.
        F.coalesce(~F.col("tripID").rlike(r"^\d+$"), F.lit(False)).alias("_ref_bad"),
    )
    return typed.withColumn("_keep", F.col("_ok") & critical_present())


def rejection_reasons(unreadable: Column | None = None) -> Column:
    """Why a raw row is rejected, over its raw columns: an array of texts, empty
    for a row that cleaning keeps. ``unreadable`` (its line, where it was no
    reading), else ``malformed:<column>`` for the trip and device, else of each
    critical column ``missing:``, ``uncastable:`` or ``nan:``."""
    typed = dict(zip(RAW_COLUMNS, typed_columns(), strict=True))
    shape = [F.when(~valid_trip_id(), F.lit("malformed:tripID")), F.when(~valid_device_id(), F.lit("malformed:deviceID"))]
    values = []
    for c in CRITICAL_COLUMNS:
        reason = F.when(F.col(c).isNull(), F.lit(f"missing:{c}")).when(typed[c].isNull(), F.lit(f"uncastable:{c}"))
        values.append(reason.when(F.isnan(typed[c]), F.lit(f"nan:{c}")) if c in NUMERIC_COLUMNS else reason)
    found = F.when(is_well_formed(), F.array_compact(F.array(*values))).otherwise(F.array_compact(F.array(*shape)))
    if unreadable is None:
        return found
    return F.when(unreadable.isNotNull(), F.array(F.lit("unreadable"))).otherwise(found)


def stats_aggregates() -> list[Column]:
    """Counters over ``with_quality_flags`` output, for one aggregate or an
    ``observe`` on the write."""
    return [
        F.sum("_copies").cast("long").alias("input_rows"),
        F.count(F.lit(1)).alias("after_dedup"),
        (F.sum("_copies") - F.count(F.lit(1))).cast("long").alias("exact_duplicates_removed"),
        F.count_if(~F.col("_ok")).alias("malformed_rows_dropped"),
        F.count_if(F.col("_ref_bad")).alias("malformed_rows_counted_by_reference"),
        F.count_if(F.col("_ok") & ~F.col("_keep")).alias("dropped_for_null_after_cast"),
        F.count_if(F.col("_keep")).alias("output_rows"),
    ]


def cleaning_stats(raw: DataFrame) -> DataFrame:
    """A1: all counters in one pass over one dedup shuffle (one row)."""
    return with_quality_flags(distinct_with_counts(raw)).agg(*stats_aggregates())
