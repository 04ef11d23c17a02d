"""The batch pipeline end to end, laid out like the original lake.

    <base>/raw/vehicle_telematics_<stamp>/                    landed messages (JSON lines)
    <base>/processed/vehicle_telematics_processed_<stamp>/    cleaned readings (Parquet)
    <base>/curated/uc1/vehicle_health_<stamp>/                vehicle health
    <base>/curated/uc2/driver_performance_<stamp>/            driver performance
    <base>/reports/<report>/<name>_<stamp>/                   report copies
    <serving>/relational/<Table>, <serving>/keyed/<Table>     serving stores
    <serving>/console/<view>                                  console tables

Each step finds its input by the newest batch stamp and names its output
with the same stamp, so steps can be re-run independently; cleaning skips a
batch that was already processed completely.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT_TOPIC, DEFAULTS, PROCESSED_BATCH, RAW_BATCH, STAMP_PATTERN, Thresholds
from ..operators import aggregates, joins
from ..session import input_bytes, tune_for_input
from ..sinks import keyed, writers
from ..sources import batches, readers
from ..streaming import streams
from . import analytics, console, loading
from .cleaning import CleanResult, clean_batch


# What both stores hold of a device.
DRIVER_STORE_COLUMNS = ["driver_safety_score", "fuel_efficiency_score", "driver_category", "driver_rank",
                        "total_trips", "aggressive_event_count"]
VEHICLE_STORE_COLUMNS = ["vehicle_health_score", "is_high_risk", "maintenance_recommendation", "risk_rank",
                         "total_alert_count"]


@dataclass
class StepResult:
    stamp: str
    outputs: tuple[str, ...]


def publish_messages(spark: SparkSession, csv_path: str, out: str, servers: str | None = None,
                     topic: str | None = None) -> None:
    """Producer: raw CSV rows → JSON messages, to a topic when ``servers`` is
    given, else as text files under ``out`` (one message per line)."""
    raw = readers.read_raw_csv(spark, csv_path)
    if servers:
        writers.write_kafka(raw, servers, topic or DEFAULT_TOPIC)
    else:
        writers.kafka_payload(raw).write.mode("overwrite").text(out)


def land_messages(spark: SparkSession, base: str, stamp: str, source: str = "text",
                  path: str | None = None, checkpoint: str | None = None, **options) -> str | None:
    """Consumer: drain what is new in the message stream into the stamped raw
    batch folder (None where nothing is). The checkpoint belongs to the source
    (one per path or topic by default), so the next run goes on where this one
    stopped; the batch counts as finished once the drain is."""
    out = writers.raw_batch_path(base, stamp)
    name = hashlib.sha256(f"{source}:{path or ''}:{options.get('subscribe', '')}".encode()).hexdigest()[:16]
    stream = streams.read_telemetry_stream(spark, source, path, **options)
    q = streams.stream_ingest_raw(stream, out, checkpoint or f"{base.rstrip('/')}/raw/_checkpoints/{name}")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if not writers.exists(spark, out):
        return None
    writers.mark_complete(spark, out)
    return out


def run_cleaning(spark: SparkSession, base: str, raw_key: str | None = None,
                 tune: bool = False) -> CleanResult:
    """Clean one raw batch (the newest if ``raw_key`` is not given); with
    ``tune`` the split and shuffle sizes follow the batch size."""
    if raw_key is None:
        raw_dir, raw_prefix = RAW_BATCH.split("{stamp}")[0].rsplit("/", 1)
        stamp, raw_key = batches.latest_batch_path(spark, f"{base.rstrip('/')}/{raw_dir}", raw_prefix)
    else:
        stamp = _stamp_of(spark, raw_key)
    if tune:
        tune_for_input(spark, input_bytes(spark, raw_key))
    raw = readers.read_raw_jsonl(spark, raw_key)
    return clean_batch(raw, writers.processed_batch_path(base, stamp))


def _stamp_of(spark: SparkSession, key: str) -> str:
    m = re.search(STAMP_PATTERN, key)
    if not m:
        raise ValueError(f"no batch stamp in {key!r}")
    return m.group(1)


def _latest_processed(spark: SparkSession, base: str, tune: bool = False) -> tuple[str, DataFrame]:
    proc_dir, proc_prefix = PROCESSED_BATCH.split("{stamp}")[0].rsplit("/", 1)
    stamp, path = batches.latest_batch_path(spark, f"{base.rstrip('/')}/{proc_dir}", proc_prefix)
    if tune:
        tune_for_input(spark, input_bytes(spark, path))
    return stamp, spark.read.parquet(path)


def run_vehicle_health(spark: SparkSession, base: str, th: Thresholds = DEFAULTS,
                       tune: bool = False) -> StepResult:
    stamp, readings = _latest_processed(spark, base, tune)
    out = writers.write_curated_and_report(
        analytics.vehicle_health(readings, th),
        writers.curated_path(base, "uc1", "vehicle_health", stamp),
        writers.report_path(base, "vehicle_health", "vehicle_health", stamp))
    return StepResult(stamp, out)


def run_driver_behavior(spark: SparkSession, base: str, th: Thresholds = DEFAULTS,
                        tune: bool = False) -> StepResult:
    stamp, readings = _latest_processed(spark, base, tune)
    out = writers.write_curated_and_report(
        analytics.driver_behavior(readings, th),
        writers.curated_path(base, "uc2", "driver_performance", stamp),
        writers.report_path(base, "driver_behavior", "driver_performance", stamp))
    return StepResult(stamp, out)


def run_scores(spark: SparkSession, base: str, th: Thresholds = DEFAULTS,
               tune: bool = False) -> StepResult:
    """Both use cases from one pass over the newest processed batch."""
    stamp, readings = _latest_processed(spark, base, tune)
    driver, vehicle = analytics.fleet_scores(readings, th)
    out = writers.write_curated_and_report(
        vehicle, writers.curated_path(base, "uc1", "vehicle_health", stamp),
        writers.report_path(base, "vehicle_health", "vehicle_health", stamp))
    out += writers.write_curated_and_report(
        driver, writers.curated_path(base, "uc2", "driver_performance", stamp),
        writers.report_path(base, "driver_behavior", "driver_performance", stamp))
    return StepResult(stamp, out)


def run_profile(spark: SparkSession, base: str, out: str, exact: bool = True, th: Thresholds = DEFAULTS) -> str:
    """Threshold evidence (A14) and signal shares (A15) of the newest processed
    batch; exact percentiles unless the sketch is asked for."""
    from ..functions import flags
    from ..operators import windows

    stamp, readings = _latest_processed(spark, base)
    cols = ["tripID", "deviceID", "timeStamp", "speed", "rpm", "kpl", "cTemp", "eLoad", "battery", "dtc"]
    rows = windows.with_speed_delta(readings.select(*cols), tiebreak=analytics.DRIVER_TIEBREAK)
    writers.write_batch(aggregates.threshold_profile(rows, exact=exact, th=th), f"{out.rstrip('/')}/thresholds_{stamp}")
    writers.write_batch(aggregates.signal_sparsity(flags.with_vehicle_flags(readings)),
                        f"{out.rstrip('/')}/signal_sparsity_{stamp}")
    return stamp


def run_inspect(spark: SparkSession, base: str, out: str, raw_key: str | None = None) -> str:
    """Q8 on a raw batch: the whole-table summary plus sample and head/tail."""
    from . import inspect

    if raw_key is None:
        raw_dir, raw_prefix = RAW_BATCH.split("{stamp}")[0].rsplit("/", 1)
        _, raw_key = batches.latest_batch_path(spark, f"{base.rstrip('/')}/{raw_dir}", raw_prefix)
    raw = readers.read_raw_jsonl(spark, raw_key)
    views = inspect.inspect(raw, order=["tripID", "deviceID", "timeStamp"])
    writers.write_batch(inspect.inspect_summary(raw), f"{out.rstrip('/')}/summary")
    writers.write_batch(views["sample"], f"{out.rstrip('/')}/sample")
    writers.write_batch(views["head_tail"], f"{out.rstrip('/')}/head_tail")
    return raw_key


def run_loads(spark: SparkSession, base: str, serving: str, jdbc: dict | None = None):
    d = loading.load_driver_serving(spark, f"{base.rstrip('/')}/curated/uc2", serving, jdbc)
    v = loading.load_vehicle_serving(spark, f"{base.rstrip('/')}/curated/uc1", serving, jdbc)
    return d, v


def run_console(spark: SparkSession, serving: str, th: Thresholds = DEFAULTS) -> dict[str, str]:
    """Console tables computed from the relational serving copies, and how
    these agree with the keyed store (J1)."""
    drivers = loading.read_relational(spark, serving, "DriverPerformance")
    vehicles = loading.read_relational(spark, serving, "VehicleHealthReport")
    views = {
        "drivers": console.driver_console(drivers),
        "vehicles": console.vehicle_console(vehicles, th),
        "driver_kpis": aggregates.driver_kpis(drivers),
        "vehicle_kpis": aggregates.vehicle_kpis(vehicles, th),
        "driver_categories": aggregates.driver_category_breakdown(drivers),
        "risk_tiers": aggregates.risk_tier_distribution(vehicles, th),
        "driver_breakdown": console.event_breakdown(drivers, "driver"),
        "vehicle_breakdown": console.event_breakdown(vehicles, "vehicle"),
    }
    for name, table, df, cols in (("driver_reconciliation", "DriverPerformance", drivers, DRIVER_STORE_COLUMNS),
                                  ("vehicle_reconciliation", "VehicleHealthReport", vehicles, VEHICLE_STORE_COLUMNS)):
        items = keyed.read_snapshot(spark, f"{serving.rstrip('/')}/keyed/{table}")
        if items is not None:
            views[name] = joins.reconcile_stores(df, items, "deviceID", cols)
    out = {}
    for name, df in views.items():
        out[name] = writers.write_batch(df, f"{serving.rstrip('/')}/console/{name}")
    return out
