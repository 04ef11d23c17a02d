"""Console computations (Q6, Q7) and their parts.

What the web console computed in the browser from full table dumps is done
here on the executors; the console then only displays ready rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS, Thresholds
from ..functions import scores

# --- fixed values: breakdown labels (must equal the console's wording) -------
DRIVER_BREAKDOWN = [
    (1, "High RPM events (rpm > 2000)", "high_rpm_count"),
    (2, "Rapid acceleration events", "rapid_accel_count"),
    (3, "Hard braking events", "hard_brake_count"),
    (4, "Total aggressive events (2+ signals)", "aggressive_event_count"),
    (5, "Total trips", "total_trips"),
    (6, "Total readings", "total_readings"),
]
VEHICLE_BREAKDOWN = [
    (1, "High RPM events (rpm > 2000)", "high_rpm_count"),
    (2, "Overheating events (cTemp > 91°C)", "overheating_count"),
    (3, "Excessive load events (eLoad > 81)", "excessive_load_count"),
    (4, "Low battery events (< 12.0V)", "low_battery_count"),
    (5, "DTC events", "dtc_count"),
    (6, "Total trips", "total_trips"),
    (7, "Total readings", "total_readings"),
]
NO_RECOMMENDATION = "N/A"


def event_breakdown(df: DataFrame, kind: str = "driver") -> DataFrame:
    """C14: per-device long-form (position, signal, count) rows."""
    items = DRIVER_BREAKDOWN if kind == "driver" else VEHICLE_BREAKDOWN
    pairs = ", ".join(f"{i}, '{label}', CAST(coalesce({c}, 0) AS BIGINT)" for i, label, c in items)
    return df.selectExpr("deviceID", f"stack({len(items)}, {pairs}) AS (position, signal, event_count)")


def driver_display_columns() -> list:
    return [
        F.col("deviceID"), F.col("driver_category"),
        F.round("driver_safety_score", 1).alias("safety_score_display"),
        F.round("fuel_efficiency_score", 1).alias("fuel_score_display"),
        F.col("total_trips"), F.col("aggressive_event_count"), F.col("driver_rank"),
        F.round("avg_speed", 1).alias("avg_speed_display"),
        F.round("avg_rpm", 0).alias("avg_rpm_display"),
    ]


def vehicle_display_columns() -> list:
    return [
        F.col("deviceID"),
        F.round("vehicle_health_score", 1).alias("health_score_display"),
        F.col("total_alert_count"),
        F.coalesce(F.col("maintenance_recommendation"), F.lit(NO_RECOMMENDATION))
         .alias("recommendation_display"),
        F.col("risk_rank"),
        *[F.round(F.when(F.col(c) != 0, F.col(c)), 1).alias(f"{c}_display") for c in ("avg_cTemp", "avg_eLoad")],
    ]


def driver_display_rows(df: DataFrame) -> DataFrame:
    """C13 (drivers): scores to 1 dp, rpm to 0 dp, as shown in the table."""
    return df.select(*driver_display_columns())


def vehicle_display_rows(df: DataFrame) -> DataFrame:
    """C13 (vehicles): health, average coolant temperature and load to 1 dp (an
    average that is missing or 0 is not shown), missing recommendation as "N/A"."""
    return df.select(*vehicle_display_columns())


def driver_console(df: DataFrame) -> DataFrame:
    """Q6: console rows for drivers in device order, with the explanation."""
    return df.select(
        *driver_display_columns(), F.col("total_readings"),
        scores.rate_text("aggressive_event_count", "total_readings").alias("event_rate_text"),
        scores.driver_explanation().alias("explanation"),
    ).orderBy("deviceID")


def vehicle_console(df: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Q7: console rows for vehicles in device order: tier, top issue, explanation."""
    return df.select(
        *vehicle_display_columns(), F.col("total_readings"),
        scores.risk_tier(th=th).alias("risk_tier"),
        scores.top_issue().alias("top_issue"),
        scores.top_issue_count().alias("top_issue_count"),
        scores.rate_text("total_alert_count", F.coalesce(F.col("total_readings"), F.lit(0)))
              .alias("alert_rate_text"),
        scores.vehicle_explanation(th).alias("explanation"),
    ).orderBy("deviceID")
