"""Q1: raw batch → cleaned Parquet batch plus cleaning counters.

One shuffle (the exact-duplicate aggregation, combined map-side) and one
action: the counters are collected with ``observe`` while the cleaned rows
are written, instead of re-reading the source for every counter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..operators import cleaning
from ..schema import CLEAN_SCHEMA, RAW_COLUMNS
from ..sinks import writers
from ..sources.readers import UNREADABLE


@dataclass
class CleanResult:
    status: str
    path: str | None
    stats: dict | None


def clean(raw: DataFrame, metrics: str | Observation = "clean_counters") -> DataFrame:
    """Cleaned rows of a raw frame (lazy): P1, P4-P6. The counters are
    published as observed metrics (query listeners see a name, an Observation
    hands them out); the observation also keeps the row filter above the typed
    projection, so every cast runs once per distinct row."""
    flagged = cleaning.with_quality_flags(cleaning.distinct_with_counts(raw))
    observed = flagged.observe(metrics, *cleaning.stats_aggregates())
    return observed.filter(F.col("_keep")).select(*CLEAN_SCHEMA.fieldNames())


def clean_batch(raw: DataFrame, out_path: str) -> CleanResult:
    """Clean ``raw`` into ``out_path`` unless that batch is already complete.

    Returns the status (PROCESSED / SKIPPED_ALREADY_PROCESSED) and, when
    processed, the six counters gathered during the write."""
    spark = raw.sparkSession
    if writers.is_complete(spark, out_path):
        return CleanResult(writers.SKIPPED, out_path, None)
    obs = Observation("clean_stats")  # gathered as the rows stream into the write
    status = writers.write_if_absent(clean(raw, obs), out_path)
    return CleanResult(status, out_path, dict(obs.get) if status == writers.PROCESSED else None)


# --- clean rows and rejected rows from one pass (P4, P6) -----------------------

def route(raw: DataFrame) -> DataFrame:
    """Every distinct raw row once: ``outcome`` (clean or rejected), the typed
    columns, ``copies`` (how often the row came), and for rejected rows
    ``reasons`` and ``raw`` (the row as it came, with its line where it was no
    reading). A frame with the column of unreadable lines
    (``readers.read_raw_jsonl_with_lines``) keeps them apart."""
    lines = [UNREADABLE] if UNREADABLE in raw.columns else []
    keys = [*RAW_COLUMNS, *lines]
    counted = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    reasons = cleaning.rejection_reasons(F.col(UNREADABLE) if lines else None)
    judged = counted.select(F.struct(*keys).alias("raw"), "copies", reasons.alias("reasons"), *cleaning.typed_columns())
    kept = F.size("reasons") == 0
    return judged.select(
        F.when(kept, F.lit("clean")).otherwise(F.lit("rejected")).alias("outcome"), *CLEAN_SCHEMA.fieldNames(), "copies",
        F.when(~kept, F.col("reasons")).alias("reasons"), F.when(~kept, F.col("raw")).alias("raw"))


def clean_with_quarantine(raw: DataFrame, base: str) -> str:
    """Write ``route(raw)`` below ``base``, the outcomes in folders of their
    own: one pass over the input, one shuffle, one commit for both."""
    route(raw).write.mode("overwrite").partitionBy("outcome").parquet(base)
    return base


ROUTED_SCHEMA = StructType([
    *CLEAN_SCHEMA.fields, StructField("copies", LongType()), StructField("reasons", ArrayType(StringType())),
    StructField("raw", StructType([StructField(c, StringType()) for c in (*RAW_COLUMNS, UNREADABLE)])),
    StructField("outcome", StringType())])


def read_routed(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(ROUTED_SCHEMA).parquet(base)


def _outcome(spark: SparkSession, base: str, outcome: str) -> DataFrame:
    return read_routed(spark, base).filter(F.col("outcome") == outcome)


def read_clean(spark: SparkSession, base: str) -> DataFrame:
    return _outcome(spark, base, "clean").select(*CLEAN_SCHEMA.fieldNames())


def read_rejected(spark: SparkSession, base: str) -> DataFrame:
    """raw, reasons, copies of the rejected rows."""
    return _outcome(spark, base, "rejected").select("raw", "reasons", "copies")


def rejection_summary(rejected: DataFrame) -> DataFrame:
    """Distinct rows and copies by reason (a row with several counts for each)."""
    return (rejected.select(F.explode("reasons").alias("reason"), "copies").groupBy("reason")
            .agg(F.count(F.lit(1)).alias("distinct_rows"), F.sum("copies").alias("copies")))
