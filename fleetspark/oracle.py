"""DuckDB SQL text used as the independent check of each registered query.

Each function returns ANSI SQL over the shared test tables; the telemetry
views are inlined as CTEs (see ``fixtures``). DuckDB specifics handled here:
``count_if`` returns HUGEINT (cast to BIGINT), decimal literals are cast to
DOUBLE to keep the DataFrame API's double arithmetic, ``row_number`` is cast
to INT, and integer casts of doubles truncate explicitly.
"""

from __future__ import annotations

from .config import (
    AGGRESSIVE_DRIVER,
    DEFAULTS,
    ECO_DRIVER,
    ISSUE_NAMES,
    NORMAL_DRIVER,
    REC_BATTERY,
    REC_COOLING,
    REC_DTC,
    REC_LOAD,
    REC_NONE,
    REC_RPM,
    TIER_HIGH,
    TIER_MODERATE,
    TIER_NORMAL,
)
from .fixtures import raw_telemetry_sql, telemetry_sql
from .functions.scores import DRIVER_SENTENCES, VEHICLE_SENTENCES
from .schema import CRITICAL_COLUMNS, NUMERIC_COLUMNS, RAW_COLUMNS

th = DEFAULTS


def d(x: float) -> str:
    """A double literal."""
    return f"CAST({x!r} AS DOUBLE)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def cnt(cond: str) -> str:
    return f"CAST(count_if({cond}) AS BIGINT)"


# --- base CTEs ---------------------------------------------------------------

def cte_telemetry() -> str:
    return f"telemetry AS (\n{telemetry_sql()}\n)"


def cte_raw() -> str:
    return f"raw_telemetry AS (\n{raw_telemetry_sql()}\n)"


def vehicle_ctes(src: str = "telemetry", out: str = "vehicle_health", p: str = "v") -> str:
    """CTE chain computing the vehicle-health table from readings ``src``."""
    return f"""{p}flags AS (
  SELECT deviceID, tripID, cTemp, eLoad,
    rpm > {d(th.high_rpm)} AS is_high_rpm,
    cTemp > {d(th.overheat_ctemp)} AS is_overheating,
    eLoad > {d(th.excessive_load)} AS is_excessive_load,
    battery < {d(th.low_battery)} AND battery > 0 AS is_low_battery,
    dtc > 0 AS is_dtc_event
  FROM {src}
), {p}flags2 AS (
  SELECT *, (CAST(is_high_rpm AS INT) + CAST(is_overheating AS INT) + CAST(is_excessive_load AS INT)
            + CAST(is_low_battery AS INT) + CAST(is_dtc_event AS INT)) >= 1 AS has_health_alert
  FROM {p}flags
), {p}agg AS (
  SELECT deviceID, count(*) AS total_readings, count(DISTINCT tripID) AS total_trips,
    {cnt('is_high_rpm')} AS high_rpm_count,
    {cnt('is_overheating')} AS overheating_count,
    {cnt('is_excessive_load')} AS excessive_load_count,
    {cnt('is_low_battery')} AS low_battery_count,
    {cnt('is_dtc_event')} AS dtc_count,
    {cnt('has_health_alert')} AS total_alert_count,
    avg(cTemp) AS avg_cTemp, avg(eLoad) AS avg_eLoad
  FROM {p}flags2 GROUP BY deviceID
), {p}s1 AS (
  SELECT *, (total_alert_count / total_readings) * 100 AS alerts_per_100_readings FROM {p}agg
), {p}s2 AS (
  SELECT *, greatest({d(0.0)}, {d(100.0)} - alerts_per_100_readings * {d(th.health_penalty)})
    AS vehicle_health_score FROM {p}s1
), {out} AS (
  SELECT deviceID, total_readings, total_trips, high_rpm_count, overheating_count,
    excessive_load_count, low_battery_count, dtc_count, total_alert_count, avg_cTemp, avg_eLoad,
    alerts_per_100_readings, vehicle_health_score,
    vehicle_health_score < {d(th.high_risk_below)} AS is_high_risk,
    CASE WHEN dtc_count > 0 THEN {q(REC_DTC)}
         WHEN low_battery_count > total_readings * {d(th.battery_share)} THEN {q(REC_BATTERY)}
         WHEN overheating_count > total_readings * {d(th.overheat_share)} THEN {q(REC_COOLING)}
         WHEN excessive_load_count > total_readings * {d(th.load_share)} THEN {q(REC_LOAD)}
         WHEN high_rpm_count > total_readings * {d(th.rpm_share)} THEN {q(REC_RPM)}
         ELSE {q(REC_NONE)} END AS maintenance_recommendation,
    CAST(row_number() OVER (ORDER BY vehicle_health_score ASC NULLS LAST, deviceID ASC) AS INT) AS risk_rank
  FROM {p}s2
)"""


def driver_flag_ctes(src: str = "telemetry", p: str = "d", tiebreak: str = "speed, rpm, kpl",
                     extra_cols: str = "") -> str:
    """Readings with speed_delta and the five driver flags as ``{p}flags2``."""
    return f"""{p}ordered AS (
  SELECT tripID, deviceID, timeStamp, speed, rpm, kpl{extra_cols},
    lag(speed) OVER (PARTITION BY tripID, deviceID ORDER BY timeStamp, {tiebreak}) AS prev_speed
  FROM {src}
), {p}delta AS (
  SELECT *, speed - prev_speed AS speed_delta FROM {p}ordered
), {p}flags AS (
  SELECT *,
    rpm > {d(th.high_rpm)} AS is_high_rpm,
    coalesce(speed_delta > {d(th.rapid_accel)}, false) AS is_rapid_accel,
    coalesce(speed_delta < {d(th.hard_brake)}, false) AS is_hard_brake,
    kpl < {d(th.poor_kpl)} AND speed > 0 AS is_poor_efficiency
  FROM {p}delta
), {p}flags2 AS (
  SELECT *, (CAST(is_high_rpm AS INT) + CAST(is_rapid_accel AS INT) + CAST(is_hard_brake AS INT))
            >= {th.aggressive_min_signals} AS is_aggressive_event
  FROM {p}flags
)"""


DRIVER_MEASURES = f"""count(*) AS total_readings,
    {cnt('is_high_rpm')} AS high_rpm_count,
    {cnt('is_rapid_accel')} AS rapid_accel_count,
    {cnt('is_hard_brake')} AS hard_brake_count,
    {cnt('is_aggressive_event')} AS aggressive_event_count,
    avg(CASE WHEN speed > 0 THEN kpl END) AS avg_kpl_while_moving,
    avg(speed) AS avg_speed, avg(rpm) AS avg_rpm"""


def driver_score_select(src: str) -> str:
    return f"""SELECT *,
    greatest({d(0.0)}, {d(100.0)} - events_per_100_readings * {d(th.safety_penalty)}) AS driver_safety_score,
    CASE WHEN avg_kpl_while_moving IS NOT NULL
         THEN least({d(100.0)}, (avg_kpl_while_moving / {d(th.kpl_reference)}) * 100) END
      AS fuel_efficiency_score
  FROM (SELECT *, (aggressive_event_count / total_readings) * 100 AS events_per_100_readings FROM {src})"""


CATEGORY = f"""CASE WHEN driver_safety_score >= {d(th.eco_min)} THEN {q(ECO_DRIVER)}
         WHEN driver_safety_score >= {d(th.normal_min)} THEN {q(NORMAL_DRIVER)}
         ELSE {q(AGGRESSIVE_DRIVER)} END"""

DRIVER_COLS = """deviceID, total_readings, total_trips, high_rpm_count, rapid_accel_count, hard_brake_count,
    aggressive_event_count, avg_kpl_while_moving, avg_speed, avg_rpm, events_per_100_readings,
    driver_safety_score, fuel_efficiency_score"""


def driver_ctes(src: str = "telemetry", out: str = "driver_performance", p: str = "d") -> str:
    return driver_flag_ctes(src, p) + f""", {p}agg AS (
  SELECT deviceID, count(DISTINCT tripID) AS total_trips, {DRIVER_MEASURES}
  FROM {p}flags2 GROUP BY deviceID
), {p}s AS (
  {driver_score_select(p + 'agg')}
), {out} AS (
  SELECT {DRIVER_COLS},
    {CATEGORY} AS driver_category,
    CAST(row_number() OVER (ORDER BY driver_safety_score DESC NULLS LAST, deviceID ASC) AS INT) AS driver_rank
  FROM {p}s
)"""


VEHICLE_CTES = vehicle_ctes()
DRIVER_CTES = driver_ctes()


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def on_vehicle(body: str) -> str:
    return with_ctes(cte_telemetry(), VEHICLE_CTES, body=body)


def on_driver(body: str) -> str:
    return with_ctes(cte_telemetry(), DRIVER_CTES, body=body)


def on_both(body: str) -> str:
    return with_ctes(cte_telemetry(), VEHICLE_CTES, DRIVER_CTES, body=body)


# --- cleaning ----------------------------------------------------------------

def _typed_select() -> str:
    cols = [
        "TRY_CAST(tripID AS INT) AS tripID",
        "TRY_CAST(trunc(TRY_CAST(deviceID AS DOUBLE)) AS INT) AS deviceID",
        "try_strptime(timeStamp, '%Y-%m-%d %H:%M:%S') AS timeStamp",
        "accData",
    ] + [f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC_COLUMNS]
    return ", ".join(cols)


WELL_FORMED = r"coalesce(regexp_matches(tripID, '^\d+$'), false) AND TRY_CAST(deviceID AS DOUBLE) IS NOT NULL"
CRITICAL_OK = " AND ".join([f"{c} IS NOT NULL" for c in CRITICAL_COLUMNS]
                           + [f"NOT isnan({c})" for c in NUMERIC_COLUMNS])

CLEAN_CTES = f"""dedup AS (
  SELECT {', '.join(RAW_COLUMNS)}, count(*) AS copies FROM raw_telemetry GROUP BY ALL
), typed AS (
  SELECT {_typed_select()}, ({WELL_FORMED}) AS well_formed, copies, tripID AS raw_tripID FROM dedup
), cleaned AS (
  SELECT {', '.join(RAW_COLUMNS)} FROM typed WHERE well_formed AND {CRITICAL_OK}
)"""


def on_clean(body: str) -> str:
    return with_ctes(cte_telemetry(), cte_raw(), CLEAN_CTES, body=body)


# --- console text ------------------------------------------------------------

def rate_text(count: str, total: str) -> str:
    """printf rounds by the exact binary value but ties to even; only odd
    sixteenths are ties, and those times 1000 are exact."""
    x = f"(CAST({count} AS DOUBLE) / CAST({total} AS DOUBLE) * 100)"
    return (f"CASE WHEN {total} > 0 THEN CASE WHEN {x} * 16 = floor({x} * 16) "
            f"THEN printf('%.3f', floor({x} * 1000 + 0.5) / 1000) ELSE printf('%.3f', {x}) END ELSE '0' END")


def thousands(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def template_sql(template: str, values: dict[str, str]) -> str:
    import re

    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(q(template[pos:m.start()]))
        parts.append(f"CAST({values[m.group(1)]} AS VARCHAR)")
        pos = m.end()
    if pos < len(template):
        parts.append(q(template[pos:]))
    return "(" + " || ".join(parts) + ")"


def driver_explanation_sql() -> str:
    vals = {"id": "deviceID", "n": "aggressive_event_count", "t": thousands("total_readings"),
            "r": rate_text("aggressive_event_count", "total_readings")}
    return (f"CASE WHEN driver_category = {q(AGGRESSIVE_DRIVER)} THEN "
            f"{template_sql(DRIVER_SENTENCES[AGGRESSIVE_DRIVER], vals)} "
            f"WHEN driver_category = {q(ECO_DRIVER)} THEN {template_sql(DRIVER_SENTENCES[ECO_DRIVER], vals)} "
            f"ELSE {template_sql(DRIVER_SENTENCES[NORMAL_DRIVER], vals)} END")


def top_issue_count_sql() -> str:
    return "greatest(" + ", ".join(f"coalesce({c}, 0)" for _, c in ISSUE_NAMES) + ")"


def top_issue_sql() -> str:
    top = top_issue_count_sql()
    whens = " ".join(f"WHEN coalesce({c}, 0) = {top} THEN {q(n)}" for n, c in ISSUE_NAMES)
    return f"CASE {whens} END"


def risk_tier_sql(score: str = "vehicle_health_score") -> str:
    return (f"CASE WHEN {score} < {d(th.high_risk_below)} THEN {q(TIER_HIGH)} "
            f"WHEN {score} < {d(th.moderate_risk_below)} THEN {q(TIER_MODERATE)} ELSE {q(TIER_NORMAL)} END")


def vehicle_explanation_sql() -> str:
    vals = {"id": "deviceID", "a": "total_alert_count", "t": thousands("coalesce(total_readings, 0)"),
            "r": rate_text("total_alert_count", "coalesce(total_readings, 0)"),
            "i": top_issue_sql(), "k": top_issue_count_sql()}
    tier = risk_tier_sql()
    return (f"CASE WHEN {tier} = {q(TIER_HIGH)} THEN {template_sql(VEHICLE_SENTENCES[TIER_HIGH], vals)} "
            f"WHEN {tier} = {q(TIER_MODERATE)} THEN {template_sql(VEHICLE_SENTENCES[TIER_MODERATE], vals)} "
            f"ELSE {template_sql(VEHICLE_SENTENCES[TIER_NORMAL], vals)} END")
