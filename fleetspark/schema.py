"""Raw and cleaned telemetry schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column order of a raw reading (all strings on ingest).
RAW_COLUMNS = [
    "tripID", "deviceID", "timeStamp", "accData",
    "gps_speed", "battery", "cTemp", "dtc", "eLoad", "iat", "imap",
    "kpl", "maf", "rpm", "speed", "tAdv", "tPos",
]

NUMERIC_COLUMNS = [
    "gps_speed", "battery", "cTemp", "dtc", "eLoad", "iat", "imap",
    "kpl", "maf", "rpm", "speed", "tAdv", "tPos",
]

# Columns that must be non-null (and non-NaN) after typing; accData is exempt.
CRITICAL_COLUMNS = ["tripID", "deviceID", "timeStamp"] + NUMERIC_COLUMNS

TRIP_KEYS = ["tripID", "deviceID"]

# Tie-break after timeStamp inside a trip: the remaining typed columns.
READING_TIEBREAK = NUMERIC_COLUMNS + ["accData"]

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])

CLEAN_SCHEMA = StructType(
    [
        StructField("tripID", IntegerType(), True),
        StructField("deviceID", IntegerType(), True),
        StructField("timeStamp", TimestampType(), True),
        StructField("accData", StringType(), True),
    ]
    + [StructField(c, DoubleType(), True) for c in NUMERIC_COLUMNS]
)

DRIVER_PERFORMANCE_SCHEMA = StructType([
    StructField("deviceID", IntegerType()),
    StructField("total_readings", LongType()),
    StructField("total_trips", LongType()),
    StructField("high_rpm_count", LongType()),
    StructField("rapid_accel_count", LongType()),
    StructField("hard_brake_count", LongType()),
    StructField("aggressive_event_count", LongType()),
    StructField("avg_kpl_while_moving", DoubleType()),
    StructField("avg_speed", DoubleType()),
    StructField("avg_rpm", DoubleType()),
    StructField("events_per_100_readings", DoubleType()),
    StructField("driver_safety_score", DoubleType()),
    StructField("fuel_efficiency_score", DoubleType()),
    StructField("driver_category", StringType()),
    StructField("driver_rank", IntegerType()),
])

VEHICLE_HEALTH_SCHEMA = StructType([
    StructField("deviceID", IntegerType()),
    StructField("total_readings", LongType()),
    StructField("total_trips", LongType()),
    StructField("high_rpm_count", LongType()),
    StructField("overheating_count", LongType()),
    StructField("excessive_load_count", LongType()),
    StructField("low_battery_count", LongType()),
    StructField("dtc_count", LongType()),
    StructField("total_alert_count", LongType()),
    StructField("avg_cTemp", DoubleType()),
    StructField("avg_eLoad", DoubleType()),
    StructField("alerts_per_100_readings", DoubleType()),
    StructField("vehicle_health_score", DoubleType()),
    StructField("is_high_risk", BooleanType()),
    StructField("maintenance_recommendation", StringType()),
    StructField("risk_rank", IntegerType()),
])

DRIVER_COLUMNS = [f.name for f in DRIVER_PERFORMANCE_SCHEMA.fields]
VEHICLE_COLUMNS = [f.name for f in VEHICLE_HEALTH_SCHEMA.fields]
