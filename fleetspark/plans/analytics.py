"""Vehicle-health (Q2) and driver-behavior (Q3) jobs as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS, Thresholds
from ..functions import flags, scores
from ..operators import aggregates, ranking, windows
from ..schema import DRIVER_COLUMNS, VEHICLE_COLUMNS
from ..session import reliable_checkpoint

# --- vehicle health --------------------------------------------------------


def vehicle_scores(agg: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """C5-C8 on the per-device aggregate."""
    out = agg.withColumn("alerts_per_100_readings", scores.per_100("total_alert_count", "total_readings"))
    out = out.withColumn("vehicle_health_score", scores.vehicle_health_score(th=th))
    return out.withColumns({
        "is_high_risk": scores.is_high_risk(th=th),
        "maintenance_recommendation": scores.maintenance_recommendation(th),
    })


def vehicle_health_unranked(readings: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """P7, P12-P16 → A5 → C5-C8 (no rank yet)."""
    needed = ["deviceID", "tripID", "rpm", "cTemp", "eLoad", "battery", "dtc"]
    flagged = flags.with_vehicle_flags(readings.select(*needed), th)
    return vehicle_scores(aggregates.vehicle_aggregate(flagged), th)


def vehicle_health(readings: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Q2: per-device health report with risk_rank (worst first). The rank
    runs jobs while the plan is built; without it, take the unranked form."""
    ranked = ranking.risk_rank(vehicle_health_unranked(readings, th))
    return ranked.select(*VEHICLE_COLUMNS)


# --- driver behavior -------------------------------------------------------

DRIVER_TIEBREAK = ["speed", "rpm", "kpl"]


def driver_flagged(readings: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """W1, W2 → P7-P11 on the columns the driver job needs."""
    needed = ["tripID", "deviceID", "timeStamp", "speed", "rpm", "kpl"]
    # Readings tied on the timestamp are ordered by the columns the job uses;
    # rows equal in all of them are interchangeable for every output, so this
    # is deterministic without reading the other columns.
    with_delta = windows.with_speed_delta(readings.select(*needed), th, tiebreak=DRIVER_TIEBREAK,
                                          start_col=aggregates.TRIP_START)
    return flags.with_driver_flags(with_delta, th)


def driver_scores(agg: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """C1-C4 on the per-device aggregate."""
    out = agg.withColumn("events_per_100_readings",
                         scores.per_100("aggressive_event_count", "total_readings"))
    out = out.withColumns({
        "driver_safety_score": scores.driver_safety_score(th=th),
        "fuel_efficiency_score": scores.fuel_efficiency_score(th=th),
    })
    return out.withColumn("driver_category", scores.driver_category(th=th))


def driver_behavior_unranked(readings: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    return driver_scores(aggregates.driver_aggregate(driver_flagged(readings, th), th), th)


def driver_behavior(readings: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Q3: per-device driver performance with driver_rank (best first). The
    rank runs jobs while the plan is built; without it, take the unranked form."""
    ranked = ranking.driver_rank(driver_behavior_unranked(readings, th))
    return ranked.select(*DRIVER_COLUMNS)


def trip_scores(readings: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """The driver scores per trip (documented, absent from the original code)."""
    return driver_scores(aggregates.trip_aggregate(driver_flagged(readings, th), th), th)


# --- summary projections (P18) and top lists (T1, T2) -----------------------

DRIVER_SUMMARY = ["deviceID", "driver_rank", "driver_category", "driver_safety_score",
                  "fuel_efficiency_score", "aggressive_event_count", "total_trips"]
VEHICLE_SUMMARY = ["deviceID", "risk_rank", "is_high_risk", "vehicle_health_score",
                   "total_alert_count", "maintenance_recommendation"]


def driver_summary_projection(df: DataFrame) -> DataFrame:
    return df.select(*DRIVER_SUMMARY)


def vehicle_summary_projection(df: DataFrame) -> DataFrame:
    return df.select(*VEHICLE_SUMMARY)


def top_drivers(df: DataFrame, n: int = 20) -> DataFrame:
    """The n best-ranked drivers (TakeOrderedAndProject: per-task top-n)."""
    return driver_summary_projection(df).orderBy("driver_rank").limit(n)


def top_risk_vehicles(df: DataFrame, n: int = 20) -> DataFrame:
    """The n worst vehicles."""
    return vehicle_summary_projection(df).orderBy("risk_rank").limit(n)


def high_risk_vehicles(df: DataFrame) -> DataFrame:
    """High-risk vehicles, worst score first."""
    return (df.filter(F.col("is_high_risk"))
              .orderBy(F.col("vehicle_health_score").asc(), F.col("deviceID").asc()))


# --- both use cases from one pass ---------------------------------------------

def fleet_aggregate(readings: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Per-device driver and vehicle measures from one scan and one trip window."""
    needed = ["tripID", "deviceID", "timeStamp", "speed", "rpm", "kpl", "cTemp", "eLoad", "battery", "dtc"]
    with_delta = windows.with_speed_delta(readings.select(*needed), th, tiebreak=DRIVER_TIEBREAK,
                                          start_col=aggregates.TRIP_START)
    flagged = flags.with_vehicle_flags(flags.with_driver_flags(with_delta, th), th)
    return flagged.groupBy("deviceID").agg(*aggregates.driver_measures(th.null_policy, starts=True),
                                           *aggregates.vehicle_measures(shared=False))


def fleet_scores(readings: DataFrame, th: Thresholds = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Q2 and Q3 from one scan, one trip-window shuffle and one per-device
    aggregate: (driver_performance, vehicle_health).

    The shared per-device table is checkpointed once; both ranks run on it."""
    base = reliable_checkpoint(fleet_aggregate(readings, th))
    driver = ranking.driver_rank(driver_scores(base, th)).select(*DRIVER_COLUMNS)
    vehicle = ranking.risk_rank(vehicle_scores(base, th)).select(*VEHICLE_COLUMNS)
    return driver, vehicle
