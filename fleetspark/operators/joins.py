"""Joins (J1, J3).

Both sides are keyed by deviceID, one row per key. The joins are
sort-merge (or hash) joins on the key chosen by Catalyst/AQE from runtime
sizes; neither side is broadcast blindly, because a fleet table grows with
the number of devices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile_stores(a: DataFrame, b: DataFrame, key: str = "deviceID",
                     cols: Sequence[str] = (), tolerance: float = 1e-4) -> DataFrame:
    """Compare the same attributes held by two stores.

    Output: key, ``<c>_a``, ``<c>_b`` per column, and ``status`` =
    ``match`` / ``mismatch`` / ``only_a`` / ``only_b``. Numbers match when
    they differ by at most ``tolerance`` (4-place rounding in one store);
    other values match with null-safe equality."""
    aa = a.select(F.col(key).cast("long").alias(key), *[F.col(c).alias(f"{c}_a") for c in cols],
                  F.lit(True).alias("_in_a"))
    bb = b.select(F.col(key).cast("long").alias(key), *[F.col(c).alias(f"{c}_b") for c in cols],
                  F.lit(True).alias("_in_b"))
    j = aa.join(bb, on=key, how="full_outer")
    numeric = {f.name for f in a.schema.fields
               if f.dataType.typeName() in ("double", "float", "decimal", "integer", "long", "short")}
    same = F.lit(True)
    for c in cols:
        ca, cb = F.col(f"{c}_a"), F.col(f"{c}_b")
        if c in numeric:
            eq = (ca.isNull() & cb.isNull()) | (F.abs(ca.cast("double") - cb.cast("double")) <= F.lit(tolerance))
        else:
            eq = ca.eqNullSafe(cb)
        same = same & F.coalesce(eq, F.lit(False))
    status = (F.when(F.col("_in_b").isNull(), F.lit("only_a"))
               .when(F.col("_in_a").isNull(), F.lit("only_b"))
               .when(same, F.lit("match"))
               .otherwise(F.lit("mismatch")))
    return j.withColumn("status", status).drop("_in_a", "_in_b")


def fleet_overview(driver: DataFrame, vehicle: DataFrame) -> DataFrame:
    """One row per device with both use cases side by side."""
    d = driver.select("deviceID", "driver_safety_score", "fuel_efficiency_score", "driver_category",
                      "driver_rank", F.col("total_readings").alias("driver_total_readings"))
    v = vehicle.select("deviceID", "vehicle_health_score", "is_high_risk",
                       "maintenance_recommendation", "risk_rank",
                       F.col("total_readings").alias("vehicle_total_readings"))
    return d.join(v, on="deviceID", how="full_outer")
