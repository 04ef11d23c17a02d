"""Telemetry views derived from the shared test tables.

The test data has no telemetry table, so readings are derived from ``events``:
one reading per event, a device per user and a trip per user-week. The same
expression text is used by Spark here and by the DuckDB oracle (as a CTE), so
both engines see identical inputs. Averaged columns stay dyadic (multiples of
1/4 and 1/1024) so float sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import RAW_COLUMNS

# --- fixed values: fixture column expressions over `events` -----------------
TELEMETRY_EXPRS = [
    "event_id",
    "CAST(user_id * 10 + floor((day(ts) - 1) / 7) AS INT) AS tripID",
    "CAST(user_id AS INT) AS deviceID",
    "ts AS timeStamp",
    "CAST(event_id % 200 AS STRING) AS accData",
    "CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) ELSE floor(least(value, CAST(160 AS DOUBLE)) * 4) / CAST(4 AS DOUBLE) END AS gps_speed",
    "CASE WHEN event_id % 50 = 0 THEN CAST(0 AS DOUBLE) "
    "WHEN user_id % 5 = 0 THEN (1195 + (event_id * 17) % 200) / CAST(100 AS DOUBLE) "
    "ELSE (1210 + (event_id * 17) % 200) / CAST(100 AS DOUBLE) END AS battery",
    "CAST((event_id * 31) % 90 + user_id % 9 AS DOUBLE) AS cTemp",
    "CASE WHEN user_id % 40 = 3 AND event_id % 10 = 3 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS dtc",
    "CAST((event_id * 53) % 80 + (user_id % 7) * 2 AS DOUBLE) AS eLoad",
    "CAST(event_id % 45 AS DOUBLE) AS iat",
    "CAST(90 + event_id % 20 AS DOUBLE) AS imap",
    "((event_id * 104729) % 2000) * (2 + user_id % 8) / CAST(1024 AS DOUBLE) AS kpl",
    "CAST(event_id % 60 AS DOUBLE) / 8 AS maf",
    "CAST((event_id * 7919) % 2000 + (user_id % 12) * 40 AS DOUBLE) AS rpm",
    "CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) ELSE floor(least(value, CAST(160 AS DOUBLE)) * 4) / CAST(4 AS DOUBLE) END AS speed",
    "CAST(event_id % 15 AS DOUBLE) AS tAdv",
    "CAST(event_id % 100 AS DOUBLE) AS tPos",
]

# Dirty-raw branches: (filter on telemetry, {column: override expression}).
RAW_BRANCHES = [
    (None, {}),
    ("event_id % 4 = 0", {}),                                   # exact duplicates
    ("event_id % 300 = 7", {c: f"'{c}'" for c in RAW_COLUMNS}),  # embedded headers
    ("event_id % 500 = 11", {"deviceID": "'dev-x'"}),
    ("event_id % 500 = 13", {"tripID": "CAST(NULL AS STRING)"}),
    ("event_id % 500 = 17", {"timeStamp": "'not-a-time'"}),
    ("event_id % 500 = 19", {"rpm": "CAST(NULL AS STRING)"}),
    ("event_id % 500 = 23", {"kpl": "'NaN'"}),
]


def _raw_expr(column: str) -> str:
    if column == "deviceID":
        return "CAST(CAST(deviceID AS DOUBLE) AS STRING)"
    if column == "timeStamp":
        return "substr(CAST(timeStamp AS STRING), 1, 19)"
    return f"CAST({column} AS STRING)"


def raw_branch_exprs(overrides: dict[str, str]) -> list[str]:
    return [f"{overrides.get(c, _raw_expr(c))} AS {c}" for c in RAW_COLUMNS]


def telemetry_sql(source: str = "events") -> str:
    return "SELECT " + ",\n  ".join(TELEMETRY_EXPRS) + f"\nFROM {source}"


def raw_telemetry_sql(source: str = "telemetry") -> str:
    parts = []
    for where, overrides in RAW_BRANCHES:
        q = "SELECT " + ", ".join(raw_branch_exprs(overrides)) + f" FROM {source}"
        if where:
            q += f" WHERE {where}"
        parts.append(q)
    return "\nUNION ALL\n".join(parts)


# --- Spark side ------------------------------------------------------------

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str, with_event_id: bool = False) -> DataFrame:
    """Clean telemetry readings (17 columns, plus event_id on request)."""
    df = read_table(spark, sf_dir, "events").selectExpr(*TELEMETRY_EXPRS)
    return df if with_event_id else df.drop("event_id")


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty raw readings: 17 string columns with duplicates and bad rows.

    Same rows as ``raw_telemetry_sql`` (the UNION ALL of the branches), built
    from one scan: every reading is exploded into the branches it belongs to
    and each column takes its branch override."""
    t = telemetry(spark, sf_dir, with_event_id=True)
    member = [F.lit(i) if where is None else F.when(F.expr(where), F.lit(i))
              for i, (where, _) in enumerate(RAW_BRANCHES)]
    rows = t.withColumn("_branch", F.explode(F.filter(F.array(*member), lambda x: x.isNotNull())))
    cols = []
    for c in RAW_COLUMNS:
        expr = F.expr(_raw_expr(c))
        for i, (_, overrides) in enumerate(RAW_BRANCHES):
            if c in overrides:
                expr = F.when(F.col("_branch") == i, F.expr(overrides[c])).otherwise(expr)
        cols.append(expr.alias(c))
    return rows.select(*cols)
