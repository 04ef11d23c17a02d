"""Thresholds and fixed values.

Every number and string here is a parameter of the analytics; the defaults are
the values the original pipeline uses, so results line up with it.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    # --- fixed values (must equal the original pipeline's) -----------------
    # driver behavior
    high_rpm: float = 2000.0          # rpm > 2000 is a high-RPM reading
    rapid_accel: float = 5.0          # speed delta > 5 km/h
    hard_brake: float = -6.0          # speed delta < -6 km/h
    poor_kpl: float = 1.2             # kpl < 1.2 while moving
    kpl_reference: float = 12.14      # fuel score reference (p90 kpl)
    safety_penalty: float = 5.0       # points per aggressive event per 100 readings
    eco_min: float = 80.0             # safety score >= 80 -> Eco Driver
    normal_min: float = 50.0          # safety score >= 50 -> Normal Driver
    aggressive_min_signals: int = 2   # 2+ of rpm / accel / brake on one row
    # vehicle health
    overheat_ctemp: float = 91.0      # cTemp > 91
    excessive_load: float = 81.0      # eLoad > 81
    low_battery: float = 12.0         # 0 < battery < 12.0
    health_penalty: float = 3.0       # points per alert row per 100 readings
    high_risk_below: float = 60.0     # score < 60 -> high risk
    moderate_risk_below: float = 80.0  # console tier: score < 80 -> moderate
    battery_share: float = 0.01       # recommendation cascade shares
    overheat_share: float = 0.05
    load_share: float = 0.05
    rpm_share: float = 0.05
    # --- engine choices (not part of the original semantics) ---------------
    # Trip time buckets used to split very long trips across tasks when
    # computing the previous reading (see operators.windows.with_previous).
    lag_bucket_seconds: int = 3600
    # "fixed": first-reading flags count as false and a never-moving driver
    # gets a null fuel score; "reference": keep the original null behavior.
    null_policy: str = "fixed"


DEFAULTS = Thresholds()

# --- fixed values: output labels (must equal the original pipeline's) -------
ECO_DRIVER = "Eco Driver"
NORMAL_DRIVER = "Normal Driver"
AGGRESSIVE_DRIVER = "Aggressive Driver"

REC_DTC = "Diagnostic scan required — active trouble codes detected"
REC_BATTERY = "Battery inspection/replacement recommended"
REC_COOLING = "Cooling system inspection recommended"
REC_LOAD = "Engine load / transmission check recommended"
REC_RPM = "Driver coaching — frequent high-RPM operation"
REC_NONE = "No immediate maintenance action indicated"

TIER_HIGH = "High Risk"
TIER_MODERATE = "Moderate Risk"
TIER_NORMAL = "Normal"

# Console issue names in tie-break order (first wins on equal counts).
ISSUE_NAMES = [
    ("high RPM", "high_rpm_count"),
    ("overheating", "overheating_count"),
    ("excessive engine load", "excessive_load_count"),
    ("low battery voltage", "low_battery_count"),
    ("diagnostic trouble codes", "dtc_count"),
]

# --- fixed values: batch naming and lake layout (as in the original layout) --
STAMP_PATTERN = r"(\d{8}_\d{6})"
STAMP_FORMAT = "yyyyMMdd_HHmmss"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
RAW_BATCH = "raw/vehicle_telematics_{stamp}"
PROCESSED_BATCH = "processed/vehicle_telematics_processed_{stamp}"
CURATED_BATCH = "curated/{uc}/{name}_{stamp}"
REPORT_BATCH = "reports/{report}/{name}_{stamp}"
DEFAULT_TOPIC = "vehicle-telematics"
EOF_FIELD = "__EOF__"
