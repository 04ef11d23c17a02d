"""Row-level event flags (column expressions, JVM-side, codegen-friendly).

Each function returns a boolean ``Column``; ``with_*`` helpers add them to a
frame in one projection.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS, Thresholds


def _int(c: Column) -> Column:
    return c.cast("int")


# --- driver behavior (P7-P11) ----------------------------------------------

def high_rpm(th: Thresholds = DEFAULTS) -> Column:
    return F.col("rpm") > F.lit(th.high_rpm)


def rapid_accel(th: Thresholds = DEFAULTS) -> Column:
    """speed_delta > threshold; null on the first reading of a trip."""
    return F.col("speed_delta") > F.lit(th.rapid_accel)


def hard_brake(th: Thresholds = DEFAULTS) -> Column:
    return F.col("speed_delta") < F.lit(th.hard_brake)


def poor_efficiency(th: Thresholds = DEFAULTS) -> Column:
    return (F.col("kpl") < F.lit(th.poor_kpl)) & (F.col("speed") > 0)


def aggressive(th: Thresholds = DEFAULTS, policy: str | None = None) -> Column:
    """Two or more of high RPM, rapid accel, hard brake on one reading.

    Poor efficiency is not a risk signal. With the "fixed" policy an unknown
    delta (first reading of a trip) counts as "no event" instead of null.
    """
    policy = policy or th.null_policy
    parts = [F.col("is_high_rpm"), F.col("is_rapid_accel"), F.col("is_hard_brake")]
    if policy == "fixed":
        parts = [F.coalesce(p, F.lit(False)) for p in parts]
    total = _int(parts[0]) + _int(parts[1]) + _int(parts[2])
    return total >= F.lit(th.aggressive_min_signals)


def with_driver_flags(df: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Adds is_high_rpm, is_rapid_accel, is_hard_brake, is_poor_efficiency and
    is_aggressive_event (needs ``speed_delta``)."""
    accel, brake = rapid_accel(th), hard_brake(th)
    if th.null_policy == "fixed":
        accel = F.coalesce(accel, F.lit(False))
        brake = F.coalesce(brake, F.lit(False))
    df = df.withColumns({
        "is_high_rpm": high_rpm(th),
        "is_rapid_accel": accel,
        "is_hard_brake": brake,
        "is_poor_efficiency": poor_efficiency(th),
    })
    return df.withColumn("is_aggressive_event", aggressive(th))


# --- vehicle health (P12-P16) ----------------------------------------------

def overheating(th: Thresholds = DEFAULTS) -> Column:
    c = F.col("cTemp") > F.lit(th.overheat_ctemp)
    # "> 0" is implied by a non-negative threshold; keep it only otherwise.
    return c if th.overheat_ctemp >= 0 else c & (F.col("cTemp") > 0)


def excessive_load(th: Thresholds = DEFAULTS) -> Column:
    c = F.col("eLoad") > F.lit(th.excessive_load)
    return c if th.excessive_load >= 0 else c & (F.col("eLoad") > 0)


def low_battery(th: Thresholds = DEFAULTS) -> Column:
    """Below the voltage threshold; zero means the sensor is off."""
    return (F.col("battery") < F.lit(th.low_battery)) & (F.col("battery") > 0)


def dtc_event(th: Thresholds = DEFAULTS) -> Column:
    return F.col("dtc") > 0


def health_alert(th: Thresholds = DEFAULTS) -> Column:
    """Any of the five signals; a row counts once however many fire."""
    signals = ("is_high_rpm", "is_overheating", "is_excessive_load", "is_low_battery", "is_dtc_event")
    return reduce(or_, [F.col(c) for c in signals])


def with_vehicle_flags(df: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    df = df.withColumns({
        "is_high_rpm": high_rpm(th),
        "is_overheating": overheating(th),
        "is_excessive_load": excessive_load(th),
        "is_low_battery": low_battery(th),
        "is_dtc_event": dtc_event(th),
    })
    return df.withColumn("has_health_alert", health_alert(th))
