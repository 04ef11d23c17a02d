"""Registered queries: name → (Spark builder, DuckDB check SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the shared test tables (the
telemetry views are derived from ``events``) and returns a DataFrame; the
work grows with the tables. Names follow the operator inventory (SURVEY §2).
Builders that exercise a sink write under the session's shared checkpoint
folder and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures
from . import oracle as O
from .functions import flags, scores, stamps
from .operators import aggregates, cleaning, joins, profiles, ranking, topk, windows
from .plans import analytics, console, incremental, inspect, loading
from .plans import cleaning as clean_plan
from .schema import CRITICAL_COLUMNS, NUMERIC_COLUMNS, RAW_COLUMNS
from .session import work_path
from .sinks import keyed, writers
from .sources import batches, readers

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# --- shared inputs -------------------------------------------------------------

def tel(spark: SparkSession, sf: str, with_id: bool = False) -> DataFrame:
    return fixtures.telemetry(spark, sf, with_event_id=with_id)


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.raw_telemetry(spark, sf)


def vh(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.vehicle_health(tel(spark, sf))


def dp(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.driver_behavior(tel(spark, sf))


def vh_unranked(spark: SparkSession, sf: str) -> DataFrame:
    """For queries that need no rank: columns prune, no job runs while planning."""
    return analytics.vehicle_health_unranked(tel(spark, sf))


def dp_unranked(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.driver_behavior_unranked(tel(spark, sf))


def first_half(df: DataFrame) -> DataFrame:
    return df.filter(F.dayofmonth("timeStamp") <= 15)


def second_half(df: DataFrame) -> DataFrame:
    return df.filter(F.dayofmonth("timeStamp") > 15)


def max_stamp(df: DataFrame) -> str:
    """Batch stamp of the newest reading (one value to the driver)."""
    return df.agg(stamps.batch_stamp(F.max("timeStamp")).alias("s")).first()["s"]


T = O.cte_telemetry()
R = O.cte_raw()
RAW_LIST = ", ".join(RAW_COLUMNS)
TEL_LIST = ", ".join(["tripID", "deviceID", "timeStamp", "accData"] + NUMERIC_COLUMNS)


def sql_tel(body: str) -> str:
    return O.with_ctes(T, body=body)


def sql_raw(body: str) -> str:
    return O.with_ctes(T, R, body=body)


# ============================================================================
# Sources (S1-S12)
# ============================================================================

@register("read_raw_csv", sql_raw(f"SELECT {RAW_LIST} FROM raw_telemetry"))
def q_read_raw_csv(spark, sf):
    """Columns in another order, and one more: the header's names decide."""
    path = work_path(spark, "raw_csv")
    (raw(spark, sf).select(*reversed(RAW_COLUMNS)).withColumn("note", F.lit("x")).write.option("header", True).csv(path))
    return readers.read_raw_csv(spark, path)


JSON_NUMBERS_SQL = sql_tel(
    "SELECT CAST(tripID AS VARCHAR) AS tripID, CAST(deviceID AS VARCHAR) AS deviceID, "
    "strftime(timeStamp, '%Y-%m-%d %H:%M:%S') AS timeStamp, accData, "
    + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in NUMERIC_COLUMNS) + " FROM telemetry")


@register("read_raw_jsonl", JSON_NUMBERS_SQL)
def q_read_raw_jsonl(spark, sf):
    """Typed readings written as JSON numbers, read back with the all-string
    schema: numbers arrive as their JSON text."""
    path = work_path(spark, "raw_jsonl")
    t = tel(spark, sf).withColumn("timeStamp", F.date_format("timeStamp", "yyyy-MM-dd HH:mm:ss"))
    t.write.json(path)
    return readers.read_raw_jsonl(spark, path)


@register("parse_raw_json", sql_raw(f"SELECT {RAW_LIST} FROM raw_telemetry"))
def q_parse_raw_json(spark, sf):
    return readers.parse_raw_json(writers.kafka_payload(raw(spark, sf)))


@register("read_batch", sql_tel(f"SELECT {TEL_LIST} FROM telemetry"))
def q_read_batch(spark, sf):
    path = work_path(spark, "processed")
    writers.write_batch(tel(spark, sf), path)
    return readers.read_batch(spark, path)


@register("read_batch_partition", sql_tel(
    f"SELECT {TEL_LIST}, strftime(timeStamp, '%Y%m%d') || '_000000' AS batch FROM telemetry "
    "WHERE strftime(timeStamp, '%Y%m%d') = (SELECT max(strftime(timeStamp, '%Y%m%d')) FROM telemetry)"))
def q_read_batch_partition(spark, sf):
    """Daily batches in a partitioned layout; the newest is read through a
    partition filter."""
    base = work_path(spark, "processed_by_day")
    day = F.concat(F.date_format("timeStamp", "yyyyMMdd"), F.lit("_000000"))
    writers.write_batch_partition(tel(spark, sf), base, day)
    return readers.read_batch_partition(spark, base)


def _key():
    """Object key named after a reading; standing readings get an unstamped
    manual-upload key."""
    stamped = F.concat(F.lit("raw/vehicle_telematics_"), stamps.batch_stamp("timeStamp"),
                       F.lit("_"), F.col("deviceID").cast("string"), F.lit(".jsonl"))
    manual = F.concat(F.lit("raw/manual_upload_"), F.col("deviceID").cast("string"), F.lit(".jsonl"))
    return F.when(F.col("speed") > 0, stamped).otherwise(manual)


def _keys(df: DataFrame) -> DataFrame:
    return df.select("event_id", _key().alias("key"))


KEYS_SQL = ("CASE WHEN speed > 0 THEN 'raw/vehicle_telematics_' || strftime(timeStamp, '%Y%m%d_%H%M%S') "
            "|| '_' || CAST(deviceID AS VARCHAR) || '.jsonl' "
            "ELSE 'raw/manual_upload_' || CAST(deviceID AS VARCHAR) || '.jsonl' END")


@register("extract_datestamp", sql_tel(
    f"SELECT event_id, {KEYS_SQL} AS key, "
    "CASE WHEN speed > 0 THEN strftime(timeStamp, '%Y%m%d_%H%M%S') END AS datestamp FROM telemetry"))
def q_extract_datestamp(spark, sf):
    k = _keys(tel(spark, sf, True))
    return k.withColumn("datestamp", stamps.extract_datestamp("key"))


def _trip_batches(df: DataFrame) -> DataFrame:
    """One curated-batch path per trip, stamped with the trip's first reading."""
    return (df.groupBy("tripID", "deviceID").agg(F.min("timeStamp").alias("t0"))
              .select(F.concat(F.lit("curated/uc2/driver_performance_"), stamps.batch_stamp("t0"),
                               F.lit("_"), F.col("tripID").cast("string"), F.lit("/")).alias("path")))


TRIP_BATCHES_SQL = ("trip_batches AS (SELECT 'curated/uc2/driver_performance_' || "
                    "strftime(min(timeStamp), '%Y%m%d_%H%M%S') || '_' || CAST(tripID AS VARCHAR) || '/' AS path "
                    "FROM telemetry GROUP BY tripID, deviceID)")


@register("list_batches", O.with_ctes(T, TRIP_BATCHES_SQL, body=(
    "SELECT path, regexp_extract(path, '(\\d{8}_\\d{6})', 1) AS datestamp FROM trip_batches")))
def q_list_batches(spark, sf):
    return batches.list_batches(_trip_batches(tel(spark, sf)))


@register("latest_batch", O.with_ctes(T, TRIP_BATCHES_SQL, body=(
    "SELECT regexp_extract(path, '(\\d{8}_\\d{6})', 1) AS datestamp, path FROM trip_batches "
    "ORDER BY datestamp DESC, path DESC LIMIT 1")))
def q_latest_batch(spark, sf):
    return batches.latest_batch(_trip_batches(tel(spark, sf)))


@register("list_raw_objects", sql_tel(
    "SELECT DISTINCT 'day=' || strftime(timeStamp, '%Y%m%d') AS folder, true AS has_objects FROM telemetry"))
def q_list_raw_objects(spark, sf):
    """Objects of a landing area with a folder per day (names are random, so
    the listing is grouped by folder)."""
    path = work_path(spark, "raw_objects")
    tel(spark, sf).withColumn("day", F.date_format("timeStamp", "yyyyMMdd")).write.partitionBy("day").json(path)
    found = readers.list_raw_objects(spark, path, "*.json")
    return (found.groupBy(F.regexp_extract("path", "/([^/]+)/[^/]+$", 1).alias("folder"))
            .agg((F.count_if(F.col("length") > 0) > 0).alias("has_objects")))


@register("parse_file_events", sql_tel(
    f"SELECT 'landing-bucket' AS bucket, {KEYS_SQL} AS key FROM telemetry WHERE speed > 0"))
def q_parse_file_events(spark, sf):
    """Notifications for stamped uploads plus foreign records (standing
    readings) that must yield no row."""
    k = tel(spark, sf).select(_key().alias("key"), "speed", "timeStamp")
    note = F.to_json(F.struct(F.array(F.struct(F.struct(
        F.struct(F.lit("landing-bucket").alias("name")).alias("bucket"),
        F.struct(F.col("key").alias("key")).alias("object")).alias("s3"))).alias("Records")))
    foreign = F.to_json(F.struct(F.lit("test_upload").alias("event"),
                                 F.col("timeStamp").cast("string").alias("timestamp"),
                                 F.lit("ok").alias("status")))
    msgs = k.select(F.when(F.col("speed") > 0, note).otherwise(foreign).alias("value"))
    return batches.parse_file_events(msgs)


ITEMS_DRIVER_SQL = """SELECT CAST(deviceID AS BIGINT) AS deviceID,
    CAST(round(driver_safety_score, 4) AS DECIMAL(20,4)) AS driver_safety_score,
    CAST(round(fuel_efficiency_score, 4) AS DECIMAL(20,4)) AS fuel_efficiency_score,
    driver_category, CAST(driver_rank AS BIGINT) AS driver_rank, total_trips, aggressive_event_count,
    {stamp} AS processed_datestamp FROM {src}"""

ITEMS_VEHICLE_SQL = """SELECT CAST(deviceID AS BIGINT) AS deviceID,
    CAST(round(vehicle_health_score, 4) AS DECIMAL(20,4)) AS vehicle_health_score,
    is_high_risk, maintenance_recommendation, CAST(risk_rank AS BIGINT) AS risk_rank,
    total_alert_count, {stamp} AS processed_datestamp FROM {src}"""

MAX_STAMP_SQL = "(SELECT strftime(max(timeStamp), '%Y%m%d_%H%M%S') FROM telemetry)"


@register("read_keyed_snapshot", O.on_driver(
    "SELECT deviceID, CAST(driver_safety_score AS DOUBLE) AS driver_safety_score, "
    "CAST(fuel_efficiency_score AS DOUBLE) AS fuel_efficiency_score, driver_category, driver_rank, "
    "total_trips, aggressive_event_count, processed_datestamp FROM ("
    + ITEMS_DRIVER_SQL.format(stamp=MAX_STAMP_SQL, src="driver_performance") + ")"))
def q_read_keyed_snapshot(spark, sf):
    t = tel(spark, sf)
    base = work_path(spark, "keyed_driver")
    keyed.write_snapshot(keyed.to_driver_score_items(analytics.driver_behavior(t), max_stamp(t)), base)
    return readers.read_keyed_snapshot(spark, base)


@register("sample_rows", sql_tel(f"SELECT event_id, {TEL_LIST} FROM telemetry ORDER BY event_id LIMIT 1000"))
def q_sample_rows(spark, sf):
    return readers.sample_rows(tel(spark, sf, True), 1000, ["event_id"])


# ============================================================================
# Sinks (K1-K13)
# ============================================================================

@register("write_raw_jsonl", sql_raw(f"SELECT {RAW_LIST} FROM raw_telemetry"))
def q_write_raw_jsonl(spark, sf):
    base = work_path(spark, "landing")
    path = writers.write_raw_jsonl(raw(spark, sf), base, "20240131_235959")
    return readers.read_raw_jsonl(spark, path)


def _payload_sql() -> str:
    parts = [f"CASE WHEN {c} IS NOT NULL THEN '\"{c}\":' || CAST(to_json({c}) AS VARCHAR) END"
             for c in RAW_COLUMNS]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


@register("kafka_payload", sql_raw(f"SELECT {_payload_sql()} AS value FROM raw_telemetry"))
def q_kafka_payload(spark, sf):
    return writers.kafka_payload(raw(spark, sf))


CLEANED_SQL = O.on_clean(f"SELECT {RAW_LIST} FROM cleaned")


@register("write_batch", CLEANED_SQL)
def q_write_batch(spark, sf):
    path = work_path(spark, "cleaned")
    writers.write_batch(clean_plan.clean(raw(spark, sf)), path)
    return spark.read.parquet(path)


@register("write_curated_and_report", O.on_vehicle("SELECT * FROM vehicle_health"))
def q_write_curated_and_report(spark, sf):
    base = work_path(spark, "lake")
    stamp = "20240131_235959"
    _, report = writers.write_curated_and_report(
        vh(spark, sf), writers.curated_path(base, "uc1", "vehicle_health", stamp),
        writers.report_path(base, "vehicle_health", "vehicle_health", stamp))
    return spark.read.parquet(report)


def _reasons_sql() -> str:
    typed = dict(zip(RAW_COLUMNS, ["TRY_CAST(tripID AS INT)", "TRY_CAST(trunc(TRY_CAST(deviceID AS DOUBLE)) AS INT)",
                                   "try_strptime(timeStamp, '%Y-%m-%d %H:%M:%S')", "accData",
                                   *[f"TRY_CAST({c} AS DOUBLE)" for c in NUMERIC_COLUMNS]], strict=True))
    trip, device = "coalesce(regexp_matches(tripID, '^\\d+$'), false)", "TRY_CAST(deviceID AS DOUBLE) IS NOT NULL"
    values = [f"CASE WHEN {c} IS NULL THEN 'missing:{c}' WHEN {typed[c]} IS NULL THEN 'uncastable:{c}'"
              + (f" WHEN isnan({typed[c]}) THEN 'nan:{c}'" if c in NUMERIC_COLUMNS else "") + " END" for c in CRITICAL_COLUMNS]
    shape = [f"CASE WHEN NOT ({trip}) THEN 'malformed:tripID' END", f"CASE WHEN NOT ({device}) THEN 'malformed:deviceID' END"]
    return f"CASE WHEN ({trip}) AND ({device}) THEN [{', '.join(values)}] ELSE [{', '.join(shape)}] END"


ROUTED_SQL = O.with_ctes(T, R, f"""counted AS (
  SELECT {RAW_LIST}, count(*) AS copies FROM raw_telemetry GROUP BY ALL
), judged AS (
  SELECT copies, list_filter({_reasons_sql()}, lambda r: r IS NOT NULL) AS reasons FROM counted
  UNION ALL SELECT CAST(1 AS BIGINT), ['unreadable'] FROM events WHERE event_id % 400 = 1
)""", body="")


def _quarantined(spark, sf) -> str:
    """Raw JSON lines and, from every 400th event, a line that is no reading."""
    src = work_path(spark, "raw_lines")
    raw(spark, sf).write.json(src)
    (fixtures.read_table(spark, sf, "events").filter("event_id % 400 = 1")
     .select(F.concat(F.lit("{broken "), F.col("event_id").cast("string")).alias("value")).write.mode("append").text(src))
    return clean_plan.clean_with_quarantine(readers.read_raw_jsonl_with_lines(spark, src), work_path(spark, "routed"))


@register("quarantine_reasons", ROUTED_SQL + (
    "SELECT reason, count(*) AS distinct_rows, CAST(sum(copies) AS BIGINT) AS copies "
    "FROM (SELECT unnest(reasons) AS reason, copies FROM judged) GROUP BY reason"))
def q_quarantine_reasons(spark, sf):
    return clean_plan.rejection_summary(clean_plan.read_rejected(spark, _quarantined(spark, sf)))


@register("quarantine_totals", ROUTED_SQL + (
    "SELECT CASE WHEN len(reasons) = 0 THEN 'clean' ELSE 'rejected' END AS outcome, count(*) AS distinct_rows, "
    "CAST(sum(copies) AS BIGINT) AS copies FROM judged GROUP BY 1"))
def q_quarantine_totals(spark, sf):
    """Both outcomes add up to the rows that came."""
    return (clean_plan.read_routed(spark, _quarantined(spark, sf)).groupBy("outcome")
            .agg(F.count(F.lit(1)).alias("distinct_rows"), F.sum("copies").alias("copies")))


@register("quarantine_clean", CLEANED_SQL)
def q_quarantine_clean(spark, sf):
    return clean_plan.read_clean(spark, _quarantined(spark, sf))


CLUSTER_FILTER = "deviceID BETWEEN 5 AND 9 AND timeStamp >= TIMESTAMP '2024-01-05 00:00:00' AND timeStamp < TIMESTAMP '2024-01-12 00:00:00'"


@register("read_clustered_batch", sql_tel(f"SELECT {TEL_LIST} FROM telemetry WHERE {CLUSTER_FILTER}"))
def q_read_clustered_batch(spark, sf):
    """A few devices and one week of a batch written in clusters of both."""
    path = work_path(spark, "clustered")
    writers.write_clustered(tel(spark, sf), path, files=32)
    return readers.read_clustered(spark, path, {"deviceID": (5, 10), "timeStamp": ("2024-01-05 00:00:00", "2024-01-12 00:00:00")})


@register("write_if_absent", O.on_clean(
    "SELECT 'PROCESSED' AS first_status, 'SKIPPED_ALREADY_PROCESSED' AS second_status, "
    "count(*) AS row_count FROM cleaned"))
def q_write_if_absent(spark, sf):
    path = work_path(spark, "idempotent")
    cleaned = clean_plan.clean(raw(spark, sf))
    s1 = writers.write_if_absent(cleaned, path)
    s2 = writers.write_if_absent(cleaned, path)
    return (spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
                 .select(F.lit(s1).alias("first_status"), F.lit(s2).alias("second_status"), "row_count"))


@register("with_load_metadata", O.on_driver(
    f"SELECT *, {MAX_STAMP_SQL} AS processed_datestamp, "
    f"strptime({MAX_STAMP_SQL}, '%Y%m%d_%H%M%S') AS loaded_at FROM driver_performance"))
def q_with_load_metadata(spark, sf):
    t = tel(spark, sf)
    st = max_stamp(t)
    # loaded_at pinned to the batch time so the result is reproducible.
    return writers.with_load_metadata(analytics.driver_behavior(t), st,
                                      loaded_at=F.to_timestamp(F.lit(st), "yyyyMMdd_HHmmss"))


@register("ensure_table", O.on_driver("SELECT * FROM driver_performance"))
def q_ensure_table(spark, sf):
    from .schema import DRIVER_PERFORMANCE_SCHEMA

    location = work_path(spark, "serving_table")
    name = "fleet_driver_performance_" + location.rsplit("-", 1)[-1]
    writers.ensure_table(spark, name, DRIVER_PERFORMANCE_SCHEMA, location)
    writers.ensure_table(spark, name, DRIVER_PERFORMANCE_SCHEMA, location)  # idempotent
    dp(spark, sf).write.insertInto(name, overwrite=True)
    return spark.table(name)


@register("batch_stamp", sql_tel("SELECT event_id, strftime(timeStamp, '%Y%m%d_%H%M%S') AS batch_stamp FROM telemetry"))
def q_batch_stamp(spark, sf):
    return tel(spark, sf, True).select("event_id", stamps.batch_stamp("timeStamp").alias("batch_stamp"))


@register("to_driver_score_items", O.on_driver(
    ITEMS_DRIVER_SQL.format(stamp=MAX_STAMP_SQL, src="driver_performance")))
def q_to_driver_score_items(spark, sf):
    t = tel(spark, sf)
    return keyed.to_driver_score_items(analytics.driver_behavior(t), max_stamp(t))


@register("to_vehicle_alert_items", O.on_vehicle(
    ITEMS_VEHICLE_SQL.format(stamp=MAX_STAMP_SQL, src="vehicle_health")))
def q_to_vehicle_alert_items(spark, sf):
    t = tel(spark, sf)
    return keyed.to_vehicle_alert_items(analytics.vehicle_health(t), max_stamp(t))


HALVES = ("first_half AS (SELECT * FROM telemetry WHERE day(timeStamp) <= 15), "
          "second_half AS (SELECT * FROM telemetry WHERE day(timeStamp) > 15)")
HALF_STAMPS = ("(SELECT strftime(max(timeStamp), '%Y%m%d_%H%M%S') FROM first_half)",
               "(SELECT strftime(max(timeStamp), '%Y%m%d_%H%M%S') FROM second_half)")


def _half_items_sql() -> str:
    return O.with_ctes(
        T, HALVES, O.vehicle_ctes("first_half", "vh_old", "vo"), O.vehicle_ctes("second_half", "vh_new", "vn"),
        f"items_old AS ({ITEMS_VEHICLE_SQL.format(stamp=HALF_STAMPS[0], src='vh_old')}), "
        f"items_new AS ({ITEMS_VEHICLE_SQL.format(stamp=HALF_STAMPS[1], src='vh_new')})",
        body="")


def _vehicle_items_halves(spark, sf):
    t = tel(spark, sf)
    a, b = first_half(t), second_half(t)
    old = keyed.to_vehicle_alert_items(analytics.vehicle_health(a), max_stamp(a))
    new = keyed.to_vehicle_alert_items(analytics.vehicle_health(b), max_stamp(b))
    return old, new


@register("upsert_keyed", _half_items_sql() + (
    "SELECT * FROM items_old WHERE deviceID NOT IN (SELECT deviceID FROM items_new) "
    "UNION ALL SELECT * FROM items_new"))
def q_upsert_keyed(spark, sf):
    old, new = _vehicle_items_halves(spark, sf)
    base = work_path(spark, "keyed_vehicle")
    keyed.upsert_snapshot(old, base)
    keyed.upsert_snapshot(new, base)
    return keyed.read_snapshot(spark, base)


TRIP_ITEMS_SQL = ("SELECT tripID, count(*) AS readings, max(timeStamp) AS last_seen, max(speed) AS top_speed "
                  "FROM {src} GROUP BY tripID")


def trip_items(t: DataFrame) -> DataFrame:
    return t.groupBy("tripID").agg(F.count(F.lit(1)).alias("readings"), F.max("timeStamp").alias("last_seen"),
                                   F.max("speed").alias("top_speed"))


@register("upsert_keyed_trips", O.with_ctes(
    T, HALVES, f"old AS ({TRIP_ITEMS_SQL.format(src='first_half')}), new AS ({TRIP_ITEMS_SQL.format(src='second_half')})",
    body="SELECT * FROM old WHERE tripID NOT IN (SELECT tripID FROM new) UNION ALL SELECT * FROM new"))
def q_upsert_keyed_trips(spark, sf):
    """A keyed table of trips: the second half of the month, day by day, over
    the first; each upsert touches the buckets of its own trips only."""
    t = tel(spark, sf)
    table = keyed.KeyedTable(spark, work_path(spark, "keyed_trips"), key="tripID", buckets=64, keep=2)
    table.upsert(trip_items(first_half(t)))
    later = trip_items(second_half(t))
    for part in range(3):  # the later trips in three uploads
        table.upsert(later.filter(F.pmod(F.crc32(F.col("tripID").cast("string")), F.lit(3)) == part), order_col="last_seen")
    return table.read()


@register("truncate_keyed", O.on_vehicle(
    "SELECT count(*) AS items_before, CAST(0 AS BIGINT) AS items_after, 7 AS attributes_after FROM vehicle_health"))
def q_truncate_keyed(spark, sf):
    """Items before and after, and that the structure stays."""
    t = tel(spark, sf)
    base = work_path(spark, "keyed_truncate")
    keyed.write_snapshot(keyed.to_vehicle_alert_items(analytics.vehicle_health(t), max_stamp(t)), base)
    before = keyed.read_snapshot(spark, base).agg(F.count(F.lit(1)).alias("items_before"))
    keyed.truncate_keyed(spark, base)
    after = keyed.read_snapshot(spark, base)
    counted = after.agg(F.count(F.lit(1)).alias("items_after"), F.lit(len(after.columns)).alias("attributes_after"))
    return before.withColumn("one", F.lit(1)).join(counted.withColumn("one", F.lit(1)), "one").drop("one")


# ============================================================================
# Projections / filters
# ============================================================================

@register("dedup_exact", sql_raw("SELECT DISTINCT * FROM raw_telemetry"))
def q_dedup_exact(spark, sf):
    return cleaning.dedup_exact(raw(spark, sf))


@register("valid_trip_id", sql_raw(
    f"SELECT {RAW_LIST}, coalesce(regexp_matches(tripID, '^\\d+$'), false) AS valid_trip_id FROM raw_telemetry"))
def q_valid_trip_id(spark, sf):
    return raw(spark, sf).withColumn("valid_trip_id", cleaning.valid_trip_id())


@register("valid_device_id", sql_raw(
    f"SELECT {RAW_LIST}, TRY_CAST(deviceID AS DOUBLE) IS NOT NULL AS valid_device_id FROM raw_telemetry"))
def q_valid_device_id(spark, sf):
    return raw(spark, sf).withColumn("valid_device_id", cleaning.valid_device_id())


@register("filter_malformed", O.on_clean(f"SELECT {RAW_LIST} FROM dedup WHERE {O.WELL_FORMED}"))
def q_filter_malformed(spark, sf):
    return cleaning.filter_malformed(cleaning.dedup_exact(raw(spark, sf)))


@register("cast_types", O.on_clean(f"SELECT {RAW_LIST} FROM typed WHERE well_formed"))
def q_cast_types(spark, sf):
    return cleaning.cast_types(cleaning.filter_malformed(cleaning.dedup_exact(raw(spark, sf))))


@register("drop_null_critical", CLEANED_SQL)
def q_drop_null_critical(spark, sf):
    return cleaning.drop_null_critical(cleaning.cast_types(cleaning.filter_malformed(cleaning.dedup_exact(raw(spark, sf)))))


VFLAG_SQL = {
    "is_high_rpm": f"rpm > {O.d(2000.0)}",
    "is_overheating": f"cTemp > {O.d(91.0)}",
    "is_excessive_load": f"eLoad > {O.d(81.0)}",
    "is_low_battery": f"battery < {O.d(12.0)} AND battery > 0",
    "is_dtc_event": "dtc > 0",
}
VFLAG_SQL["has_health_alert"] = "(" + " OR ".join(f"({v})" for v in VFLAG_SQL.values()) + ")"
VFLAG_QUERIES = {
    "flag_high_rpm": "is_high_rpm",
    "flag_overheating": "is_overheating",
    "flag_excessive_load": "is_excessive_load",
    "flag_low_battery": "is_low_battery",
    "flag_dtc": "is_dtc_event",
    "flag_health_alert": "has_health_alert",
}


def _vflag_builder(col: str) -> Builder:
    def build(spark, sf):
        return flags.with_vehicle_flags(tel(spark, sf, True)).select("event_id", col)
    return build


for _name, _col in VFLAG_QUERIES.items():
    REGISTRY[_name] = (_vflag_builder(_col),
                       sql_tel(f"SELECT event_id, {VFLAG_SQL[_col]} AS {_col} FROM telemetry"))


ROW_TIEBREAK = ["speed", "rpm", "kpl", "event_id"]


def driver_rows(spark, sf) -> DataFrame:
    """Readings with event_id, prev_speed, speed_delta and the driver flags."""
    t = tel(spark, sf, True).select("event_id", "tripID", "deviceID", "timeStamp", "speed", "rpm", "kpl")
    return flags.with_driver_flags(windows.with_speed_delta(t, tiebreak=ROW_TIEBREAK))


DROWS_SQL = O.with_ctes(T, O.driver_flag_ctes("telemetry", "r", "speed, rpm, kpl, event_id", ", event_id"),
                        body="")

for _name, _col in {"flag_rapid_accel": "is_rapid_accel", "flag_hard_brake": "is_hard_brake",
                    "flag_poor_efficiency": "is_poor_efficiency",
                    "flag_aggressive": "is_aggressive_event"}.items():
    REGISTRY[_name] = ((lambda c: lambda spark, sf: driver_rows(spark, sf).select("event_id", c))(_col),
                       DROWS_SQL + f"SELECT event_id, {_col} FROM rflags2")


@register("high_risk_vehicles", O.on_vehicle("SELECT * FROM vehicle_health WHERE is_high_risk"))
def q_high_risk_vehicles(spark, sf):
    return analytics.high_risk_vehicles(vh(spark, sf))


@register("driver_summary_projection", O.on_driver(
    "SELECT " + ", ".join(analytics.DRIVER_SUMMARY) + " FROM driver_performance"))
def q_driver_summary_projection(spark, sf):
    return analytics.driver_summary_projection(dp(spark, sf))


@register("vehicle_summary_projection", O.on_vehicle(
    "SELECT " + ", ".join(analytics.VEHICLE_SUMMARY) + " FROM vehicle_health"))
def q_vehicle_summary_projection(spark, sf):
    return analytics.vehicle_summary_projection(vh(spark, sf))


# ============================================================================
# Joins (J1, J3)
# ============================================================================

RECONCILE_COLS = ["vehicle_health_score", "is_high_risk", "maintenance_recommendation", "risk_rank",
                  "total_alert_count"]


def _reconcile_sql() -> str:
    same = " AND ".join(
        [f"coalesce((a.{c} IS NULL AND b.{c} IS NULL) OR abs(CAST(a.{c} AS DOUBLE) - CAST(b.{c} AS DOUBLE)) "
         f"<= {O.d(1e-4)}, false)" for c in ("vehicle_health_score", "risk_rank", "total_alert_count")]
        + [f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in ("is_high_risk", "maintenance_recommendation")])
    cols = ", ".join(f"a.{c} AS {c}_a, b.{c} AS {c}_b" for c in RECONCILE_COLS)
    snap = ("snapshot AS (SELECT * FROM items_old WHERE deviceID NOT IN (SELECT deviceID FROM items_new) "
            "UNION ALL SELECT * FROM items_new)")
    return _half_items_sql() + (
        f", {snap} SELECT coalesce(a.deviceID, b.deviceID) AS deviceID, {cols}, "
        f"CASE WHEN b.deviceID IS NULL THEN 'only_a' WHEN a.deviceID IS NULL THEN 'only_b' "
        f"WHEN {same} THEN 'match' ELSE 'mismatch' END AS status "
        "FROM (SELECT CAST(deviceID AS BIGINT) AS deviceID, * EXCLUDE (deviceID) FROM vh_new) a "
        "FULL OUTER JOIN snapshot b ON a.deviceID = b.deviceID")


@register("reconcile_stores", _reconcile_sql())
def q_reconcile_stores(spark, sf):
    """Relational store (replaced by the newest load) against the keyed store
    (upserted by both loads)."""
    t = tel(spark, sf)
    a, b = first_half(t), second_half(t)
    current = analytics.vehicle_health(b)
    snap = keyed.upsert_keyed(keyed.to_vehicle_alert_items(analytics.vehicle_health(a), max_stamp(a)),
                              keyed.to_vehicle_alert_items(current, max_stamp(b)))
    return joins.reconcile_stores(current, snap, "deviceID", RECONCILE_COLS)


@register("fleet_overview", O.on_both(
    "SELECT coalesce(d.deviceID, v.deviceID) AS deviceID, d.driver_safety_score, d.fuel_efficiency_score, "
    "d.driver_category, d.driver_rank, d.total_readings AS driver_total_readings, v.vehicle_health_score, "
    "v.is_high_risk, v.maintenance_recommendation, v.risk_rank, v.total_readings AS vehicle_total_readings "
    "FROM driver_performance d FULL OUTER JOIN vehicle_health v ON d.deviceID = v.deviceID"))
def q_fleet_overview(spark, sf):
    # both use cases from one pass over the readings
    return joins.fleet_overview(*analytics.fleet_scores(tel(spark, sf)))


# ============================================================================
# Aggregations
# ============================================================================

@register("cleaning_stats", O.on_clean(
    "SELECT CAST(sum(copies) AS BIGINT) AS input_rows, count(*) AS after_dedup, "
    "CAST(sum(copies) - count(*) AS BIGINT) AS exact_duplicates_removed, "
    "CAST(count_if(NOT well_formed) AS BIGINT) AS malformed_rows_dropped, "
    "CAST(count_if(NOT coalesce(regexp_matches(raw_tripID, '^\\d+$'), true)) AS BIGINT) "
    "AS malformed_rows_counted_by_reference, "
    f"CAST(count_if(well_formed AND NOT coalesce({O.CRITICAL_OK}, false)) AS BIGINT) AS dropped_for_null_after_cast, "
    f"CAST(count_if(well_formed AND coalesce({O.CRITICAL_OK}, false)) AS BIGINT) AS output_rows FROM typed"))
def q_cleaning_stats(spark, sf):
    return cleaning.cleaning_stats(raw(spark, sf))


@register("driver_event_counts", DROWS_SQL + (
    "SELECT " + ", ".join(O.cnt(c) + f" AS {a}" for c, a in [
        ("is_high_rpm", "high_rpm_events"), ("is_rapid_accel", "rapid_accel_events"),
        ("is_hard_brake", "hard_brake_events"), ("is_poor_efficiency", "poor_efficiency_rows"),
        ("is_aggressive_event", "aggressive_events")]) + ", count(*) AS total_rows FROM rflags2"))
def q_driver_event_counts(spark, sf):
    return aggregates.driver_event_counts(driver_rows(spark, sf))


@register("vehicle_event_counts", sql_tel(
    "SELECT " + ", ".join(O.cnt(VFLAG_SQL[c]) + f" AS {a}" for c, a in [
        ("is_high_rpm", "high_rpm_events"), ("is_overheating", "overheating_events"),
        ("is_excessive_load", "excessive_load_events"), ("is_low_battery", "low_battery_events"),
        ("is_dtc_event", "dtc_events"), ("has_health_alert", "total_alert_rows")])
    + ", count(*) AS total_rows FROM telemetry"))
def q_vehicle_event_counts(spark, sf):
    return aggregates.vehicle_event_counts(flags.with_vehicle_flags(tel(spark, sf)))


@register("driver_aggregate", O.on_driver(
    "SELECT deviceID, total_readings, total_trips, high_rpm_count, rapid_accel_count, hard_brake_count, "
    "aggressive_event_count, avg_kpl_while_moving, avg_speed, avg_rpm FROM dagg"))
def q_driver_aggregate(spark, sf):
    return aggregates.driver_aggregate(analytics.driver_flagged(tel(spark, sf)))


@register("vehicle_aggregate", O.on_vehicle("SELECT * FROM vagg"))
def q_vehicle_aggregate(spark, sf):
    return aggregates.vehicle_aggregate(flags.with_vehicle_flags(tel(spark, sf)))


@register("trip_aggregate", O.on_driver(
    f"SELECT * EXCLUDE (total_trips), {O.CATEGORY} AS driver_category FROM ("
    + O.driver_score_select(
        f"(SELECT tripID, deviceID, CAST(1 AS BIGINT) AS total_trips, {O.DRIVER_MEASURES} "
        "FROM dflags2 GROUP BY tripID, deviceID)") + ")"))
def q_trip_aggregate(spark, sf):
    return analytics.trip_scores(tel(spark, sf)).drop("total_trips")


@register("driver_category_breakdown", O.on_driver(
    "SELECT driver_category, count(*) AS drivers FROM driver_performance GROUP BY driver_category"))
def q_driver_category_breakdown(spark, sf):
    return aggregates.driver_category_breakdown(dp_unranked(spark, sf))


@register("risk_tier_distribution", O.on_vehicle(
    "SELECT * FROM (VALUES (1, 'Normal'), (2, 'Moderate Risk'), (3, 'High Risk')) t(tier_order, risk_tier) "
    f"LEFT JOIN (SELECT {O.risk_tier_sql()} AS tier, count(*) AS n FROM vehicle_health GROUP BY 1) c "
    "ON c.tier = t.risk_tier").replace(
        "SELECT * FROM (VALUES", "SELECT tier_order, risk_tier, coalesce(n, 0) AS vehicles FROM (VALUES"))
def q_risk_tier_distribution(spark, sf):
    return aggregates.risk_tier_distribution(vh_unranked(spark, sf))


@register("driver_kpis", O.on_driver(
    "SELECT count(*) AS driver_count, round(avg(driver_safety_score), 0) AS avg_safety_score, "
    "round(avg(fuel_efficiency_score), 0) AS avg_fuel_score, CAST(sum(aggressive_event_count) AS BIGINT) "
    "AS total_aggressive_events FROM driver_performance"))
def q_driver_kpis(spark, sf):
    return aggregates.driver_kpis(dp_unranked(spark, sf))


@register("vehicle_kpis", O.on_vehicle(
    "SELECT count(*) AS vehicle_count, round(avg(vehicle_health_score), 1) AS avg_health_score, "
    "CAST(sum(total_alert_count) AS BIGINT) AS total_alerts, "
    f"{O.cnt('vehicle_health_score < ' + O.d(60.0))} AS high_risk_count FROM vehicle_health"))
def q_vehicle_kpis(spark, sf):
    return aggregates.vehicle_kpis(vh_unranked(spark, sf))


@register("table_row_count", O.on_vehicle("SELECT count(*) AS row_count FROM vehicle_health"))
def q_table_row_count(spark, sf):
    return aggregates.table_row_count(vh_unranked(spark, sf))


def _profile_sql(src: str = "raw_telemetry") -> str:
    """Per-column null counts as rows (position, column_name, data_type, null_count)."""
    return " UNION ALL ".join(
        f"SELECT {i + 1} AS position, '{c}' AS column_name, 'string' AS data_type, "
        f"{O.cnt(c + ' IS NULL')} AS null_count FROM {src}" for i, c in enumerate(RAW_COLUMNS))


@register("profile_columns", sql_raw(
    "SELECT (SELECT count(*) FROM raw_telemetry) AS row_count, * FROM (" + _profile_sql() + ")"))
def q_profile_columns(spark, sf):
    return aggregates.profile_columns(raw(spark, sf))


SKETCHED = ("tripID", "deviceID", "timeStamp", "speed", "rpm", "kpl", "accData")


@register("profile_sketches", sql_tel(" UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
    f"count(DISTINCT {c}) AS distinct_values, true AS distinct_within_bound, true AS median_within_bound FROM telemetry"
    for i, c in enumerate(SKETCHED))))
def q_profile_sketches(spark, sf):
    """Three batches profiled alone, their sketches merged, and the estimates
    held against exact figures: distinct values within 5 standard errors (8 %),
    the median's rank within 1 % of the rows."""
    t = tel(spark, sf).select(*SKETCHED)
    day = F.dayofmonth("timeStamp")
    states = [profiles.profile_state(t.filter(day.between(a, b))) for a, b in ((1, 10), (11, 20), (21, 31))]
    report = profiles.profile_report(profiles.merge_states(states[0].unionAll(states[1]).unionAll(states[2])), shares=(0.5,)).collect()
    exact = t.agg(*[F.count_distinct(c).alias(f"d{i}") for i, c in enumerate(SKETCHED)],
                  *[x for i, r in enumerate(sorted(report, key=lambda r: r["position"])) if r["quantiles"] for v in (F.lit(r["quantiles"][0]),)
                    for c in ((F.unix_micros(F.col(r["column_name"]).cast("timestamp")) if r["column_name"] == "timeStamp"
                               else F.col(r["column_name"])).cast("double"),)
                    for x in (F.count_if(c < v).alias(f"b{i}"), F.count_if(c <= v).alias(f"u{i}"))]).first().asDict()
    rows = []
    for r in report:
        i, n = r["position"] - 1, r["rows"] - r["nulls"]
        near = r["quantiles"] is None or exact[f"b{i}"] - 0.01 * n <= 0.5 * n <= exact[f"u{i}"] + 0.01 * n
        rows.append((r["position"], r["column_name"], r["rows"], r["nulls"], exact[f"d{i}"],
                     abs(r["distinct_values"] - exact[f"d{i}"]) <= 0.08 * exact[f"d{i}"] + 1, near))
    return spark.createDataFrame(rows, "position int, column_name string, row_count long, null_count long, distinct_values long, "
                                       "distinct_within_bound boolean, median_within_bound boolean")


@register("duplicate_count", sql_raw(
    "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM "
    "(SELECT count(*) AS n FROM raw_telemetry GROUP BY " + RAW_LIST + ")"))
def q_duplicate_count(spark, sf):
    return aggregates.duplicate_count(raw(spark, sf))


@register("threshold_profile", DROWS_SQL + (
    "SELECT quantile_cont(rpm, 0.95) AS p95_rpm, "
    "quantile_cont(CASE WHEN speed_delta > 0 THEN speed_delta END, 0.99) AS p99_positive_speed_delta, "
    "quantile_cont(speed_delta, 0.01) AS p01_speed_delta, "
    "quantile_cont(CASE WHEN speed > 0 THEN kpl END, 0.25) AS p25_kpl_moving, "
    "quantile_cont(kpl, 0.90) AS p90_kpl, "
    "quantile_cont(CASE WHEN cTemp <> 0 THEN cTemp END, 0.90) AS p90_ctemp_nonzero, "
    "quantile_cont(CASE WHEN cTemp <> 0 THEN cTemp END, 0.95) AS p95_ctemp_nonzero, "
    "quantile_cont(CASE WHEN eLoad <> 0 THEN eLoad END, 0.95) AS p95_eload_nonzero, "
    "count_if(battery <> 0 AND battery < 12.0) / count_if(battery <> 0) AS share_low_battery_nonzero "
    "FROM rflags2 JOIN (SELECT event_id, cTemp, eLoad, battery FROM telemetry) USING (event_id)"))
def q_threshold_profile(spark, sf):
    # the columns the profile needs ride along through the trip window (no join back)
    t = tel(spark, sf, True).select("event_id", "tripID", "deviceID", "timeStamp", "speed", "rpm", "kpl",
                                    "cTemp", "eLoad", "battery")
    return aggregates.threshold_profile(windows.with_speed_delta(t, tiebreak=ROW_TIEBREAK))


@register("signal_sparsity", sql_tel(
    "SELECT total_rows, signal, rows_firing, rows_firing / total_rows AS share FROM (SELECT count(*) AS total_rows, "
    + ", ".join(O.cnt(VFLAG_SQL[s]) + f" AS {s}" for s in aggregates.SPARSITY_SIGNALS)
    + " FROM telemetry) UNPIVOT (rows_firing FOR signal IN ("
    + ", ".join(aggregates.SPARSITY_SIGNALS) + "))"))
def q_signal_sparsity(spark, sf):
    return aggregates.signal_sparsity(flags.with_vehicle_flags(tel(spark, sf)))


# ============================================================================
# Windows (W1-W7)
# ============================================================================

@register("with_prev_speed", DROWS_SQL + "SELECT event_id, prev_speed FROM rflags2")
def q_with_prev_speed(spark, sf):
    t = tel(spark, sf, True).select("event_id", "tripID", "deviceID", "timeStamp", "speed", "rpm", "kpl")
    return windows.with_previous(t, ["speed"], tiebreak=ROW_TIEBREAK).select("event_id", "prev_speed")


@register("with_speed_delta", DROWS_SQL + "SELECT event_id, prev_speed, speed_delta FROM rflags2")
def q_with_speed_delta(spark, sf):
    return driver_rows(spark, sf).select("event_id", "prev_speed", "speed_delta")


@register("driver_rank", O.on_driver("SELECT deviceID, driver_safety_score, driver_rank FROM driver_performance"))
def q_driver_rank(spark, sf):
    return dp(spark, sf).select("deviceID", "driver_safety_score", "driver_rank")


@register("risk_rank", O.on_vehicle("SELECT deviceID, vehicle_health_score, risk_rank FROM vehicle_health"))
def q_risk_rank(spark, sf):
    return vh(spark, sf).select("deviceID", "vehicle_health_score", "risk_rank")


@register("percentile_safety_score", O.on_driver(
    "SELECT deviceID, events_per_100_readings, "
    "percent_rank() OVER (ORDER BY events_per_100_readings DESC) * 100 AS percentile_safety_score "
    "FROM driver_performance"))
def q_percentile_safety_score(spark, sf):
    return ranking.percentile_safety_score(dp_unranked(spark, sf)).select(
        "deviceID", "events_per_100_readings", "percentile_safety_score")


@register("gap_aware_speed_delta", O.with_ctes(T, body=(
    "SELECT event_id, prev_speed, gap_seconds, CASE WHEN gap_seconds <= 1.0 THEN speed - prev_speed END "
    "AS speed_delta FROM (SELECT event_id, speed, "
    "lag(speed) OVER w AS prev_speed, "
    "(epoch_us(timeStamp) - epoch_us(lag(timeStamp) OVER w)) / 1000000.0 AS gap_seconds "
    "FROM telemetry WINDOW w AS (PARTITION BY tripID, deviceID ORDER BY timeStamp, speed, rpm, kpl, event_id))")))
def q_gap_aware_speed_delta(spark, sf):
    t = tel(spark, sf, True).select("event_id", "tripID", "deviceID", "timeStamp", "speed", "rpm", "kpl")
    out = windows.with_gap_aware_speed_delta(t, 1.0, tiebreak=ROW_TIEBREAK)
    return out.select("event_id", "prev_speed", "gap_seconds", "speed_delta")


@register("rank_fleet_distributed", O.on_driver(
    "SELECT deviceID, driver_safety_score, driver_rank FROM driver_performance"))
def q_rank_fleet_distributed(spark, sf):
    unranked = analytics.driver_behavior_unranked(tel(spark, sf))
    return ranking.driver_rank(unranked, rows_per_partition=50).select(
        "deviceID", "driver_safety_score", "driver_rank")


# ============================================================================
# Sorts / top-k
# ============================================================================

@register("top_drivers", O.on_driver(
    "SELECT " + ", ".join(analytics.DRIVER_SUMMARY) + " FROM driver_performance ORDER BY driver_rank LIMIT 20"))
def q_top_drivers(spark, sf):
    return analytics.top_drivers(dp(spark, sf), 20)


@register("top_risk_vehicles", O.on_vehicle(
    "SELECT " + ", ".join(analytics.VEHICLE_SUMMARY) + " FROM vehicle_health ORDER BY risk_rank LIMIT 20"))
def q_top_risk_vehicles(spark, sf):
    return analytics.top_risk_vehicles(vh(spark, sf), 20)


@register("order_by_device", O.on_vehicle("SELECT * FROM vehicle_health ORDER BY deviceID"))
def q_order_by_device(spark, sf):
    return topk.order_by_device(vh(spark, sf))


@register("head_tail", sql_tel(
    f"(SELECT event_id, {TEL_LIST}, 'head' AS side FROM telemetry ORDER BY event_id LIMIT 5) UNION ALL "
    f"(SELECT event_id, {TEL_LIST}, 'tail' AS side FROM telemetry ORDER BY event_id DESC LIMIT 5)"))
def q_head_tail(spark, sf):
    return topk.head_tail(tel(spark, sf, True), 5, ["event_id"])


@register("top_issue", O.on_vehicle(
    f"SELECT deviceID, {O.top_issue_sql()} AS top_issue, {O.top_issue_count_sql()} AS top_issue_count "
    "FROM vehicle_health"))
def q_top_issue(spark, sf):
    return vh_unranked(spark, sf).select("deviceID", scores.top_issue().alias("top_issue"),
                                scores.top_issue_count().alias("top_issue_count"))


# ============================================================================
# Scalar functions
# ============================================================================

def _dcol(name: str, expr_sql: str | None = None):
    sql = O.on_driver(f"SELECT deviceID, {expr_sql or name} AS {name} FROM driver_performance")
    REGISTRY[name] = (lambda spark, sf: dp_unranked(spark, sf).select("deviceID", name), sql)


def _vcol(name: str, expr_sql: str | None = None):
    sql = O.on_vehicle(f"SELECT deviceID, {expr_sql or name} AS {name} FROM vehicle_health")
    REGISTRY[name] = (lambda spark, sf: vh_unranked(spark, sf).select("deviceID", name), sql)


for _n in ("events_per_100_readings", "driver_safety_score", "fuel_efficiency_score", "driver_category"):
    _dcol(_n)
for _n in ("alerts_per_100_readings", "vehicle_health_score", "is_high_risk", "maintenance_recommendation"):
    _vcol(_n)


@register("risk_tier", O.on_vehicle(f"SELECT deviceID, {O.risk_tier_sql()} AS risk_tier FROM vehicle_health"))
def q_risk_tier(spark, sf):
    return vh_unranked(spark, sf).select("deviceID", scores.risk_tier().alias("risk_tier"))


@register("event_rate_text", O.on_both(
    f"SELECT d.deviceID, {O.rate_text('d.aggressive_event_count', 'd.total_readings')} AS event_rate_text, "
    f"{O.rate_text('v.total_alert_count', 'v.total_readings')} AS alert_rate_text "
    "FROM driver_performance d JOIN vehicle_health v USING (deviceID)"))
def q_event_rate_text(spark, sf):
    d = dp_unranked(spark, sf).select("deviceID", scores.rate_text("aggressive_event_count", "total_readings")
                             .alias("event_rate_text"))
    v = vh_unranked(spark, sf).select("deviceID", scores.rate_text("total_alert_count", "total_readings")
                             .alias("alert_rate_text"))
    return d.join(v, "deviceID")


@register("driver_explanation", O.on_driver(
    f"SELECT deviceID, {O.driver_explanation_sql()} AS explanation FROM driver_performance"))
def q_driver_explanation(spark, sf):
    return dp_unranked(spark, sf).select("deviceID", scores.driver_explanation().alias("explanation"))


@register("vehicle_explanation", O.on_vehicle(
    f"SELECT deviceID, {O.vehicle_explanation_sql()} AS explanation FROM vehicle_health"))
def q_vehicle_explanation(spark, sf):
    return vh_unranked(spark, sf).select("deviceID", scores.vehicle_explanation().alias("explanation"))


DRIVER_DISPLAY_SQL = ("deviceID, driver_category, round(driver_safety_score, 1) AS safety_score_display, "
                      "round(fuel_efficiency_score, 1) AS fuel_score_display, total_trips, "
                      "aggressive_event_count, driver_rank, round(avg_speed, 1) AS avg_speed_display, "
                      "round(avg_rpm, 0) AS avg_rpm_display")
VEHICLE_DISPLAY_SQL = ("deviceID, round(vehicle_health_score, 1) AS health_score_display, total_alert_count, "
                       "coalesce(maintenance_recommendation, 'N/A') AS recommendation_display, risk_rank, "
                       "round(nullif(avg_cTemp, 0), 1) AS avg_cTemp_display, round(nullif(avg_eLoad, 0), 1) AS avg_eLoad_display")


@register("driver_display_row", O.on_driver(f"SELECT {DRIVER_DISPLAY_SQL} FROM driver_performance"))
def q_driver_display_row(spark, sf):
    return console.driver_display_rows(dp(spark, sf))


@register("vehicle_display_row", O.on_vehicle(f"SELECT {VEHICLE_DISPLAY_SQL} FROM vehicle_health"))
def q_vehicle_display_row(spark, sf):
    return console.vehicle_display_rows(vh(spark, sf))


def _breakdown_sql(items, table: str, on) -> str:
    rows = " UNION ALL ".join(
        f"SELECT deviceID, {i} AS position, '{label}' AS signal, CAST(coalesce({c}, 0) AS BIGINT) AS event_count "
        f"FROM {table}" for i, label, c in items)
    return on(rows)


@register("driver_event_breakdown", _breakdown_sql(console.DRIVER_BREAKDOWN, "driver_performance", O.on_driver))
def q_driver_event_breakdown(spark, sf):
    return console.event_breakdown(dp_unranked(spark, sf), "driver")


@register("vehicle_event_breakdown", _breakdown_sql(console.VEHICLE_BREAKDOWN, "vehicle_health", O.on_vehicle))
def q_vehicle_event_breakdown(spark, sf):
    return console.event_breakdown(vh_unranked(spark, sf), "vehicle")


@register("round4_decimal", O.on_driver(
    "SELECT deviceID, CAST(round(driver_safety_score, 4) AS DECIMAL(20,4)) AS safety_dec4, "
    "CAST(round(fuel_efficiency_score, 4) AS DECIMAL(20,4)) AS fuel_dec4 FROM driver_performance"))
def q_round4_decimal(spark, sf):
    return dp_unranked(spark, sf).select("deviceID", scores.round4_decimal("driver_safety_score").alias("safety_dec4"),
                                scores.round4_decimal("fuel_efficiency_score").alias("fuel_dec4"))


@register("decimal_to_native", O.on_driver(
    "SELECT deviceID, CAST(CAST(round(driver_safety_score, 4) AS DECIMAL(20,4)) AS DOUBLE) AS safety_native "
    "FROM driver_performance"))
def q_decimal_to_native(spark, sf):
    d = dp_unranked(spark, sf).select("deviceID", scores.round4_decimal("driver_safety_score").alias("dec"))
    return d.select("deviceID", scores.decimal_to_native("dec").alias("safety_native"))


# ============================================================================
# Composite jobs (Q1-Q8)
# ============================================================================

@register("clean_batch", CLEANED_SQL)
def q_clean_batch(spark, sf):
    out = work_path(spark, "processed_batch")
    res = clean_plan.clean_batch(raw(spark, sf), out)
    return spark.read.parquet(res.path)


# Q2 and Q3 (the flagship jobs)
@register("vehicle_health", O.on_vehicle("SELECT * FROM vehicle_health"))
def q_vehicle_health(spark, sf):
    return vh(spark, sf)


@register("driver_behavior", O.on_driver("SELECT * FROM driver_performance"))
def q_driver_behavior(spark, sf):
    return dp(spark, sf)


def _fleet_state(spark, sf) -> incremental.FleetState:
    """Three uploads of the month; trips span two of them."""
    state = incremental.FleetState(spark, work_path(spark, "fleet_state"))
    t = tel(spark, sf)
    for n, (lo, hi) in enumerate([(1, 10), (11, 20), (21, 31)]):
        state.apply(t.filter(F.dayofmonth("timeStamp").between(lo, hi)), n)
    return state


@register("driver_behavior_incremental", O.on_driver("SELECT * FROM driver_performance"))
def q_driver_behavior_incremental(spark, sf):
    return _fleet_state(spark, sf).driver_performance()


@register("vehicle_health_incremental", O.on_vehicle("SELECT * FROM vehicle_health"))
def q_vehicle_health_incremental(spark, sf):
    return _fleet_state(spark, sf).vehicle_health()


def _both_stores(spark, sf, kind: str) -> DataFrame:
    """Two curated batches (one per half of the month), each loaded when it is
    there: the relational store holds the second, the keyed store also the
    devices that only the first has."""
    base, serving = work_path(spark, "curated"), work_path(spark, "serving")
    job, uc, name, load, table, items = (
        (analytics.driver_behavior, "uc2", "driver_performance", loading.load_driver_serving, "DriverPerformance",
         keyed.to_driver_score_items) if kind == "driver" else
        (analytics.vehicle_health, "uc1", "vehicle_health", loading.load_vehicle_serving, "VehicleHealthReport",
         keyed.to_vehicle_alert_items))
    t = tel(spark, sf)
    for part in (first_half(t), second_half(t)):
        writers.write_batch(job(part), writers.curated_path(base, uc, name, max_stamp(part)))
        res = load(spark, f"{base}/curated/{uc}", serving)
    relational = loading.read_relational(spark, serving, table)
    stores = {"keyed": keyed.read_snapshot(spark, res.snapshot), "relational": items(relational, F.col("processed_datestamp"))}
    a, b = (df.withColumn("store", F.lit(n)) for n, df in stores.items())
    return a.unionByName(b)


def _both_stores_sql(ctes: str) -> str:
    return ctes + (", snapshot AS (SELECT * FROM items_old WHERE deviceID NOT IN (SELECT deviceID FROM items_new) "
                   "UNION ALL SELECT * FROM items_new) SELECT *, 'keyed' AS store FROM snapshot "
                   "UNION ALL SELECT *, 'relational' AS store FROM items_new")


def _half_driver_items_sql() -> str:
    return O.with_ctes(
        T, HALVES, O.driver_ctes("first_half", "dp_old", "do_"), O.driver_ctes("second_half", "dp_new", "dn"),
        f"items_old AS ({ITEMS_DRIVER_SQL.format(stamp=HALF_STAMPS[0], src='dp_old')}), "
        f"items_new AS ({ITEMS_DRIVER_SQL.format(stamp=HALF_STAMPS[1], src='dp_new')})",
        body="")


@register("load_driver_serving", _both_stores_sql(_half_driver_items_sql()))
def q_load_driver_serving(spark, sf):
    return _both_stores(spark, sf, "driver")


@register("load_vehicle_serving", _both_stores_sql(_half_items_sql()))
def q_load_vehicle_serving(spark, sf):
    return _both_stores(spark, sf, "vehicle")


@register("driver_console", O.on_driver(
    f"SELECT {DRIVER_DISPLAY_SQL}, total_readings, "
    f"{O.rate_text('aggressive_event_count', 'total_readings')} AS event_rate_text, "
    f"{O.driver_explanation_sql()} AS explanation FROM driver_performance ORDER BY deviceID"))
def q_driver_console(spark, sf):
    return console.driver_console(dp(spark, sf))


@register("vehicle_console", O.on_vehicle(
    f"SELECT {VEHICLE_DISPLAY_SQL}, total_readings, {O.risk_tier_sql()} AS risk_tier, "
    f"{O.top_issue_sql()} AS top_issue, {O.top_issue_count_sql()} AS top_issue_count, "
    f"{O.rate_text('total_alert_count', 'coalesce(total_readings, 0)')} AS alert_rate_text, "
    f"{O.vehicle_explanation_sql()} AS explanation FROM vehicle_health ORDER BY deviceID"))
def q_vehicle_console(spark, sf):
    return console.vehicle_console(vh(spark, sf))


INSPECT_SQL = sql_raw(
    "SELECT 'rows' AS metric, CAST(NULL AS INT) AS position, CAST(NULL AS VARCHAR) AS column_name, "
    "CAST(NULL AS VARCHAR) AS data_type, count(*) AS value FROM raw_telemetry UNION ALL "
    "SELECT 'nulls', position, column_name, data_type, null_count FROM (" + _profile_sql() + ") UNION ALL "
    "SELECT 'duplicate_rows', NULL, NULL, NULL, CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM "
    "(SELECT count(*) AS n FROM raw_telemetry GROUP BY " + RAW_LIST + ")")


@register("inspect", INSPECT_SQL)
def q_inspect(spark, sf):
    return inspect.inspect_summary(raw(spark, sf))


# ============================================================================
# Streaming
# ============================================================================

from .streaming import streams  # noqa: E402


def _messages(spark, sf) -> DataFrame:
    """Raw readings as JSON messages plus one end-of-data record per device."""
    r = raw(spark, sf)
    eof = (tel(spark, sf).select("deviceID").distinct()
           .select(F.lit('{"' + streams.EOF_FIELD + '": true}').alias("value")))
    return writers.kafka_payload(r).unionByName(eof)


def _stage_messages(spark, sf) -> str:
    path = work_path(spark, "messages")
    _messages(spark, sf).write.text(path)
    return path


def _drain(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


RAW_SQL = sql_raw(f"SELECT {RAW_LIST} FROM raw_telemetry")


@register("read_telemetry_stream", RAW_SQL)
def q_read_telemetry_stream(spark, sf):
    src = _stage_messages(spark, sf)
    out, ck = work_path(spark, "stream_raw"), work_path(spark, "ck")
    stream = streams.read_telemetry_stream(spark, "text", src, maxFilesPerTrigger=4)
    _drain(streams.write_append_to_parquet(streams.raw_readings(stream), out, ck))
    return spark.read.parquet(out)


@register("stream_ingest_raw", RAW_SQL)
def q_stream_ingest_raw(spark, sf):
    src = _stage_messages(spark, sf)
    out, ck = work_path(spark, "landing_stream"), work_path(spark, "ck")
    stream = streams.read_telemetry_stream(spark, "text", src, maxFilesPerTrigger=4)
    _drain(streams.stream_ingest_raw(stream, out, ck))
    return readers.read_raw_jsonl(spark, out)


@register("drop_eof", RAW_SQL)
def q_drop_eof(spark, sf):
    return streams.raw_readings(_messages(spark, sf))


@register("stream_clean", CLEANED_SQL)
def q_stream_clean(spark, sf):
    """The whole raw table arrives twice: copies meet across micro-batches."""
    src = work_path(spark, "raw_json")
    for _ in range(2):
        raw(spark, sf).write.mode("append").json(src)
    out, ck = work_path(spark, "stream_clean"), work_path(spark, "ck")
    stream = streams.read_telemetry_stream(spark, "json", src, maxFilesPerTrigger=2)
    _drain(streams.write_append_to_parquet(streams.stream_clean(stream), out, ck))
    return spark.read.parquet(out)


STAGE_FILES = 4  # files of a slice, and files of a micro-batch


def _stage_readings(spark, sf, slices: list[tuple[int, int]] | None = None) -> str:
    """Typed readings (with event_id) as Parquet files, written slice by
    slice in time order (each trip's readings of a slice in one file)."""
    path = work_path(spark, "readings")
    t = tel(spark, sf, True)
    for lo, hi in slices or [(1, 31)]:
        part = t.filter((F.dayofmonth("timeStamp") >= lo) & (F.dayofmonth("timeStamp") <= hi))
        part.repartition(STAGE_FILES, "tripID", "deviceID").write.mode("append").parquet(path)
    return path


def _reading_schema(spark, sf):
    return tel(spark, sf, True).schema


@register("stream_flags", sql_tel(
    "SELECT event_id, " + ", ".join(f"{v} AS {k}" for k, v in VFLAG_SQL.items()) + " FROM telemetry"))
def q_stream_flags(spark, sf):
    src = _stage_readings(spark, sf)
    out, ck = work_path(spark, "stream_flags"), work_path(spark, "ck")
    stream = streams.read_telemetry_stream(spark, "parquet", src, _reading_schema(spark, sf))
    flagged = streams.stream_flags(stream).select("event_id", *VFLAG_SQL.keys())
    _drain(streams.write_append_to_parquet(flagged, out, ck))
    return spark.read.parquet(out)


SIX_DAY_SLICES = [(1, 6), (7, 12), (13, 18), (19, 24), (25, 31)]


@register("stream_speed_delta", DROWS_SQL + "SELECT event_id, prev_speed, speed_delta FROM rflags2")
def q_stream_speed_delta(spark, sf):
    """Readings arrive in six-day slices (a trip spans two), several
    micro-batches; the trip state carries the last speed across them."""
    src = _stage_readings(spark, sf, SIX_DAY_SLICES)
    out, ck = work_path(spark, "stream_delta"), work_path(spark, "ck")
    stream = streams.read_telemetry_stream(spark, "parquet", src, _reading_schema(spark, sf),
                                           maxFilesPerTrigger=4)
    deltas = streams.stream_speed_delta(stream, order=("timeStamp", "speed", "rpm", "kpl", "event_id"))
    _drain(streams.write_append_to_parquet(deltas.select("event_id", "prev_speed", "speed_delta"), out, ck))
    return spark.read.parquet(out)


@register("stream_speed_corrections", DROWS_SQL + "SELECT event_id, prev_speed, speed_delta FROM rflags2")
def q_stream_speed_corrections(spark, sf):
    """Readings arrive in no order, in four hash slices: each late one corrects
    its successor, and the last revisions equal the batch result."""
    src = work_path(spark, "shuffled")
    t = tel(spark, sf, True).select("event_id", "tripID", "deviceID", "timeStamp", "speed", "rpm", "kpl")
    for k in range(4):
        t.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k).repartition(STAGE_FILES, "event_id").write.mode("append").parquet(src)
    out, ck = work_path(spark, "stream_corrections"), work_path(spark, "ck")
    stream = streams.read_telemetry_stream(spark, "parquet", src, t.schema, maxFilesPerTrigger=STAGE_FILES)
    rows = streams.stream_speed_corrections(stream, "60 days", order=("timeStamp", "speed", "rpm", "kpl", "event_id"))
    _drain(streams.write_append_to_parquet(rows, out, ck))
    return streams.latest_revision(spark.read.parquet(out), ["event_id"]).select("event_id", "prev_speed", "speed_delta")


@register("stream_alert_windows", sql_tel(
    "SELECT date_trunc('day', timeStamp) AS window_start, date_trunc('day', timeStamp) + INTERVAL 1 DAY "
    "AS window_end, deviceID, count(*) AS readings, "
    + ", ".join(O.cnt(VFLAG_SQL[c]) + f" AS {a}" for c, a in [
        ("has_health_alert", "alert_rows"), ("is_high_rpm", "high_rpm_count"),
        ("is_overheating", "overheating_count"), ("is_excessive_load", "excessive_load_count"),
        ("is_low_battery", "low_battery_count"), ("is_dtc_event", "dtc_count")])
    + " FROM telemetry GROUP BY 1, 2, 3"))
def q_stream_alert_windows(spark, sf):
    """Append mode; a heartbeat after the last reading closes the last windows."""
    src = _stage_readings(spark, sf, SIX_DAY_SLICES)
    last = tel(spark, sf).agg(F.max("timeStamp") + F.expr("INTERVAL 10 DAYS")).first()[0]
    streams.heartbeat(_reading_schema(spark, sf), last, spark).write.mode("append").parquet(src)
    out, ck = work_path(spark, "stream_windows"), work_path(spark, "ck")
    stream = streams.read_telemetry_stream(spark, "parquet", src, _reading_schema(spark, sf),
                                           maxFilesPerTrigger=4)
    _drain(streams.write_append_to_parquet(streams.stream_alert_windows(stream, "1 day"), out, ck))
    return spark.read.parquet(out)


@register("stream_upsert_scores", REGISTRY["upsert_keyed"][1])
def q_stream_upsert_scores(spark, sf):
    old, new = _vehicle_items_halves(spark, sf)
    src = work_path(spark, "items")
    old.write.parquet(src)
    new.write.mode("append").parquet(src)
    snap, ck = work_path(spark, "keyed_stream"), work_path(spark, "ck")
    stream = spark.readStream.schema(old.schema).option("maxFilesPerTrigger", 2).parquet(src)
    _drain(streams.stream_upsert_scores(stream, snap, ck))
    return keyed.read_snapshot(spark, snap)
