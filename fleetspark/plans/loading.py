"""Q4 / Q5: load the newest curated batch into the two serving stores.

Relational store: replaced on every load (JDBC overwrite+truncate when a URL
is given, else a Parquet serving table). Key-value store: a keyed snapshot
upserted by deviceID (devices missing from the batch survive there, as in
the original design). No rows pass through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sinks import keyed, writers
from ..sources import batches


@dataclass
class LoadResult:
    datestamp: str
    batch_path: str
    relational: str
    snapshot: str


def _load(spark: SparkSession, curated_base: str, prefix: str, serving_base: str,
          items, jdbc: dict | None, table: str) -> LoadResult:
    stamp, path = batches.latest_batch_path(spark, curated_base, prefix)
    df = spark.read.parquet(path)
    # Loaded-at is the load time; the batch stamp names what was loaded.
    loaded = writers.with_load_metadata(df, stamp)
    if jdbc:
        writers.write_serving_table(loaded, jdbc["url"], table, jdbc.get("properties"))
        relational = f"{jdbc['url']}#{table}"
    else:
        relational = writers.write_batch(loaded, f"{serving_base.rstrip('/')}/relational/{table}")
    snap = f"{serving_base.rstrip('/')}/keyed/{table}"
    keyed.upsert_snapshot(items(df, stamp), snap)
    return LoadResult(stamp, path, relational, snap)


def load_driver_serving(spark: SparkSession, curated_base: str, serving_base: str,
                        jdbc: dict | None = None) -> LoadResult:
    """Q4: S7 → S5 → K13 → K6 (or Parquet) + K11 → K7."""
    return _load(spark, curated_base, "driver_performance_", serving_base,
                 keyed.to_driver_score_items, jdbc, "DriverPerformance")


def load_vehicle_serving(spark: SparkSession, curated_base: str, serving_base: str,
                         jdbc: dict | None = None) -> LoadResult:
    """Q5: S7 → S5 → K13 → K6 (or Parquet) + K12 → K7."""
    return _load(spark, curated_base, "vehicle_health_", serving_base,
                 keyed.to_vehicle_alert_items, jdbc, "VehicleHealthReport")


def read_relational(spark: SparkSession, serving_base: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{serving_base.rstrip('/')}/relational/{table}")
