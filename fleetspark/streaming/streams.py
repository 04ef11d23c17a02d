"""Structured Streaming versions of ingest, cleaning and scoring.

Every query is checkpointed (exactly-once with the file sink / idempotent
``foreachBatch``) and can run continuously or as ``availableNow`` to drain
what is there and stop - which replaces the end-of-data sentinel record and
the never-committed consumer offsets of a hand-written consumer loop.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BinaryType, DoubleType, IntegralType, LongType, StructField, StructType

from ..commits import Landing
from ..config import DEFAULTS, EOF_FIELD, Thresholds
from ..functions import flags
from ..operators import cleaning
from ..schema import CLEAN_SCHEMA, RAW_COLUMNS, RAW_SCHEMA
from ..sinks import keyed
from ..sources.readers import parse_raw_json


# --- S4: sources ---------------------------------------------------------------

def read_telemetry_stream(spark: SparkSession, source: str, path: str | None = None,
                          schema: StructType | None = None, **options) -> DataFrame:
    """Open a stream of raw messages.

    ``source="kafka"``: needs ``kafka.bootstrap.servers`` and ``subscribe``;
    reads from the earliest offset and yields the ``value`` as a string.
    ``source="text"``: one JSON message per line in files under ``path``
    (same ``value`` column). ``source="json"`` / ``"parquet"``: readings
    with ``schema`` (the raw schema by default for JSON)."""
    r = spark.readStream
    for k, v in options.items():
        r = r.option(k, v)
    if source == "kafka":
        return (r.format("kafka").option("startingOffsets", options.get("startingOffsets", "earliest"))
                 .load().select(F.col("value").cast("string").alias("value")))
    if source == "text":
        return r.format("text").load(path)
    if source == "json":
        return r.schema(schema or RAW_SCHEMA).json(path)
    if source == "parquet":
        return r.schema(schema).parquet(path)
    raise ValueError(f"unknown stream source {source!r}")


# --- X2 / X1 -------------------------------------------------------------------

def drop_eof(df: DataFrame, col: str = "value") -> DataFrame:
    """Drop in-band end-of-data records (``{"__EOF__": true}``)."""
    marker = F.get_json_object(F.col(col), f"$.{EOF_FIELD}")
    return df.filter(marker.isNull())


def raw_readings(messages: DataFrame, col: str = "value") -> DataFrame:
    """Messages → raw all-string readings (EOF records removed)."""
    return parse_raw_json(drop_eof(messages, col), col)


def start(writer: DataStreamWriter, available_now: bool = True, every: str = "30 seconds") -> StreamingQuery:
    """Drain what is there and stop, or run on with a micro-batch ``every`` so often."""
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()


def stream_ingest_raw(messages: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                      every: str = "30 seconds") -> StreamingQuery:
    """Land the raw readings as JSON-lines files under ``out_path``.

    ``checkpoint`` belongs to the source, not to the folder: a later run with
    another ``out_path`` lands what came since. A micro-batch is written to a
    folder of its own and becomes visible by one commit file
    (``commits.Landing``): no file is renamed, ``readers.read_raw_jsonl`` sees whole
    micro-batches only, and a retried one lands once."""
    def sink(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            Landing(batch.sparkSession, out_path).add(batch.write.json, stream_id(batch.sparkSession, checkpoint), epoch)

    return start(raw_readings(messages).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint),
                 available_now, every)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


# --- X3 / X4 -------------------------------------------------------------------

def stream_clean(raw: DataFrame, dedup_window: str = "10 minutes",
                 metrics_name: str = "stream_clean_stats") -> DataFrame:
    """P1-P6 on a stream.

    Contract for copies: a row equal to one that arrived at most
    ``dedup_window`` earlier is removed; a copy that arrives later is a new
    reading (clean the batch, Q1, to remove those). Arrival is the start of
    the micro-batch, so a backlog drained slowly needs a longer window. State
    is bounded by the rows of one window, and no reading is dropped for being
    late in event time (a device uploading a backlog is kept whole).

    Per micro-batch counters appear in the query progress: under
    ``<metrics_name>_in`` the rows that arrived, under ``metrics_name`` those
    after dedup (the difference are the copies removed), malformed, dropped
    after the casts, and kept; the observation also keeps the row filter above
    the typed projection, so each cast runs once per row."""
    arrived = (raw.select(*RAW_COLUMNS).observe(f"{metrics_name}_in", F.count(F.lit(1)).alias("arrived"))
                  .withColumn("_arrival", F.current_timestamp()))
    deduped = (arrived.withWatermark("_arrival", dedup_window)
                      .dropDuplicatesWithinWatermark(RAW_COLUMNS))
    flagged = cleaning.with_quality_flags(deduped.withColumn("_copies", F.lit(1)))
    observed = flagged.observe(
        metrics_name,
        F.count(F.lit(1)).alias("after_dedup"),
        F.count_if(~F.col("_ok")).alias("malformed_rows_dropped"),
        F.count_if(F.col("_ok") & ~F.col("_keep")).alias("dropped_for_null_after_cast"),
        F.count_if(F.col("_keep")).alias("output_rows"))
    return observed.filter(F.col("_keep")).select(*CLEAN_SCHEMA.fieldNames())


def stream_flags(readings: DataFrame, th: Thresholds = DEFAULTS) -> DataFrame:
    """Row-local vehicle-health flags (stateless)."""
    return flags.with_vehicle_flags(readings, th)


# --- X5: previous speed across micro-batches -----------------------------------

# Trips are dealt by hash to this many state keys, each worked on as arrays. A
# checkpoint holds trips by it, so it does not change.
STATE_KEYS = 1024
# State of one key: what its trips keep, as an Arrow table (values and types come back exactly).
TRIPS_STATE = StructType([StructField("trips", BinaryType())])
TRIP = ["tripID", "deviceID"]
_NULL = "_no_"  # prefix of the column that tells whether a whole number is null
_LEAST = np.iinfo(np.int64).min  # also what a null time is as a number


def _packed(kept: pd.DataFrame) -> bytes:
    rows = pa.Table.from_pandas(kept, preserve_index=False).replace_schema_metadata(None)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(trips: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(trips).read_all().to_pandas()


def _nulls(rows: pd.DataFrame, col: str) -> np.ndarray:
    return (rows[_NULL + col] if _NULL + col in rows else rows[col].isna()).to_numpy(dtype=bool)


def _sort_keys(rows: pd.DataFrame, cols: Sequence[str], nulls_first: bool) -> list[np.ndarray]:
    """Keys for ``np.lexsort`` (the last counts most) that order by ``cols``."""
    keys = []
    for c in reversed(cols):
        null, values = _nulls(rows, c), rows[c]
        values = values.to_numpy() if values.dtype.kind in "biuf" else pd.factorize(values, sort=True)[0]
        keys += [np.where(null, 0, values), null != nulls_first]
    return keys


def _speeds(rows: pd.DataFrame) -> np.ndarray:
    return np.where(_nulls(rows, "speed"), np.nan, rows["speed"].to_numpy(dtype="float64", na_value=np.nan))


def _by_trip(readings: DataFrame, cols: Sequence[str], ts: str, more: list[StructField], idle_timeout: str | None,
             step: Callable[..., tuple[pd.DataFrame, pd.DataFrame]]) -> DataFrame:
    """The columns ``cols`` and ``more`` of the rows that ``step`` makes of the
    trips' new readings and of what the trips have kept.

    ``step(new, kept)`` takes the new readings of some trips (``_t``: time in
    us) and what these have kept, or None, and returns the rows to emit and
    what is kept from now on; ``_trip`` numbers the trips in both. Trips
    without new readings are left as they are. With ``idle_timeout`` each trip
    goes by its own last arrival (``_seen``)."""
    idle_ms = None if idle_timeout is None else _interval_us(idle_timeout) // 1000
    src = readings.select(*cols).withColumn(ts, F.col(ts).cast("timestamp"))
    # pandas has no null whole numbers: beside others they would become floats
    whole = {f.name: f.dataType for f in src.schema.fields if isinstance(f.dataType, IntegralType)}
    sent = (src.select("*", *[F.col(c).isNull().alias(_NULL + c) for c in whole])
               .withColumns({c: F.coalesce(c, F.lit(0).cast(t)) for c, t in whole.items()}))
    trip = TRIP + [_NULL + c for c in TRIP if c in whole]
    out_schema = StructType([*sent.schema.fields, *more])

    def run(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = 0 if idle_ms is None else state.getCurrentProcessingTimeMs()
        rest, out = _unpacked(state.get[0]) if state.exists else None, None
        if not (idle_ms is not None and state.hasTimedOut):
            new = pd.concat(list(batches), ignore_index=True)
            new["_t"] = new[ts].to_numpy().astype("datetime64[us]").astype("int64")
            known = 0 if rest is None else len(rest)
            both = new[trip] if rest is None else pd.concat([rest[trip], new[trip]], ignore_index=True)
            number = both.groupby(trip, dropna=False, sort=False).ngroup().to_numpy()
            new["_trip"], mine = number[known:], None
            if rest is not None:
                here = np.isin(number[:known], number[known:])
                mine, rest = rest[here].assign(_trip=number[:known][here]), rest[~here]
            out, mine = step(new, mine)
            mine = mine.drop(columns="_trip").assign(_seen=now)
            rest = mine if rest is None or rest.empty else pd.concat([rest, mine], ignore_index=True)
        if idle_ms is not None:
            rest = rest[rest["_seen"] + idle_ms >= now]
        if rest.empty:
            state.remove()
        else:
            state.update((_packed(rest),))
            if idle_ms is not None:
                state.setTimeoutDuration(max(1, int(rest["_seen"].min()) + idle_ms - now))
        if out is not None:
            yield out[out_schema.names]

    dealt = sent.withColumn("_key", F.pmod(F.xxhash64(*TRIP), F.lit(STATE_KEYS)))
    rows = dealt.groupBy("_key").applyInPandasWithState(
        run, out_schema, TRIPS_STATE, "append",
        GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout)
    return rows.select(*[F.when(~F.col(_NULL + c), F.col(c)).alias(c) if c in whole else c for c in src.columns],
                       *[f.name for f in more])


def stream_speed_delta(readings: DataFrame, order: Sequence[str] = ("timeStamp", "speed", "rpm", "kpl"),
                       passthrough: Sequence[str] = (), idle_timeout: str | None = None) -> DataFrame:
    """``prev_speed`` / ``speed_delta`` per trip on a stream.

    ``lag`` is not allowed on streams, so each trip keeps its own last reading;
    nothing depends on other trips or on how many partitions run. The trips
    are dealt to ``STATE_KEYS`` state keys, so that Python is called once for
    many trips: the readings of a micro-batch are sorted and shifted as arrays,
    a trip's first taking the stored one.

    No event-time watermark is used, so no reading is dropped for arriving
    late: a reading older than its trip's stored one gets no delta. By default
    a trip's state (two numbers) stays. A stream that runs on can name an
    ``idle_timeout``: the state then goes when the trip itself has sent nothing
    for so long in processing time, which bounds it by the trips active
    within that span; a reading after that starts the trip anew. (With a
    timeout Spark always plans another batch, so such a query does not drain
    and stop; a checkpoint keeps the form it began with.) Output: tripID,
    deviceID, ``order`` columns, ``passthrough``, prev_speed, speed_delta."""
    order = list(order)
    cols = list(dict.fromkeys(TRIP + order + list(passthrough)))

    def step(new: pd.DataFrame, kept: pd.DataFrame | None) -> tuple[pd.DataFrame, pd.DataFrame]:
        new = new.iloc[np.lexsort([*_sort_keys(new, order[1:], False), new["_t"], new["_trip"]])]
        trip, t, speed = new["_trip"].to_numpy(), new["_t"].to_numpy(), _speeds(new)
        n = 1 + max(trip[-1], -1 if kept is None else kept["_trip"].max())
        last_t, last_speed = np.full(n, _LEAST), np.full(n, np.nan)
        if kept is not None:
            last_t[kept["_trip"]], last_speed[kept["_trip"]] = kept["last_t"], kept["last_speed"]
        late = t < last_t[trip]
        first, prev = np.r_[True, (trip[1:] != trip[:-1]) | late[:-1]], np.r_[np.nan, speed[:-1]]
        prev[first] = last_speed[trip[first]]
        prev[late] = np.nan
        end = np.r_[trip[1:] != trip[:-1], True] & ~late
        ends = new.loc[end, [c for c in new if c.removeprefix(_NULL) in TRIP] + ["_trip"]].assign(last_t=t[end], last_speed=speed[end])
        if kept is not None:
            ends = pd.concat([kept[~kept["_trip"].isin(trip[end])], ends], ignore_index=True)
        return new.assign(prev_speed=prev, speed_delta=speed - prev), ends

    return _by_trip(readings, cols, order[0], [StructField("prev_speed", DoubleType()), StructField("speed_delta", DoubleType())],
                    idle_timeout, step)


def merge_trips(trip: np.ndarray, t: np.ndarray, keys: list[np.ndarray], speed: np.ndarray, revision: np.ndarray,
                is_new: np.ndarray, lateness_us: int) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
    """Trips' next readings among those that they keep.

    A place in the arrays is a reading: its trip's number, time in us, further
    sort keys, speed and revision. Those kept stand before the new ones.
    Returns what is to be emitted (places, previous speeds, revisions), the
    places of what is to be kept, in order, and the revisions of these: the
    readings of the last ``lateness_us`` before a trip's newest, and the one
    before them.

    A new reading is emitted with the speed before it (revision 0). If it comes
    to stand before a kept one, that one is emitted again with its new
    predecessor (its revision, one higher). A reading older than the allowed
    lateness has no known predecessor: revision -1, and it corrects nothing."""
    def since(places: np.ndarray) -> np.ndarray:
        newest = np.full(trip.max(initial=-1) + 1, _LEAST)
        np.maximum.at(newest, trip[places], t[places])
        return np.maximum(newest, _LEAST + lateness_us) - lateness_us

    late = is_new & (t < since(~is_new)[trip])
    at = np.lexsort([*keys, t, trip])
    at = at[~late[at]]
    same = np.r_[False, trip[at][1:] == trip[at][:-1]][:len(at)]
    behind_new = same & np.r_[False, is_new[at][:-1]][:len(at)]
    before = np.where(same, np.r_[np.nan, speed[at][:-1]][:len(at)], np.nan)
    revisions = revision[at] + (behind_new & ~is_new[at])
    emit, gone = is_new[at] | behind_new, np.flatnonzero(late)
    stay = t[at] >= since(at)[trip[at]]
    keep = stay | np.r_[same[1:] & stay[1:], False][:len(at)]
    return ((np.r_[gone, at[emit]], np.r_[np.full(len(gone), np.nan), before[emit]], np.r_[np.full(len(gone), -1), revisions[emit]]),
            at[keep], revisions[keep])


def merge_readings(kept: list[list], new: list[list], lateness_us: int) -> tuple[list[tuple[list, float | None, int]], list[list]]:
    """``merge_trips`` for one trip, on lists: an entry is [time in us, further
    order values ..., speed, revision]; ``kept`` is in order. Returns what is to
    be emitted, as (entry, previous speed, revision), and the entries to keep."""
    entries = [*kept, *new]
    rows = pd.DataFrame([e[1:-2] for e in entries]).add_prefix("_")
    t, revision = (np.array([e[i] for e in entries], dtype="int64") for i in (0, -1))
    speed = np.array([e[-2] for e in entries], dtype="float64")
    (places, before, revisions), keep, kept_revisions = merge_trips(
        np.zeros(len(entries), dtype="int64"), t, _sort_keys(rows, list(rows), True), speed, revision,
        np.arange(len(entries)) >= len(kept), lateness_us)
    return ([([*entries[i][:-1], max(0, r)], None if b != b else b, r) for i, b, r in zip(places, before.tolist(), revisions.tolist(), strict=True)],
            [[*entries[i][:-1], r] for i, r in zip(keep, kept_revisions.tolist(), strict=True)])


def stream_speed_corrections(readings: DataFrame, lateness: str = "10 minutes",
                             order: Sequence[str] = ("timeStamp", "speed", "rpm", "kpl"),
                             idle_timeout: str | None = None) -> DataFrame:
    """X5 with corrections: ``prev_speed`` / ``speed_delta`` per trip, in which
    a late reading gets its delta and its successor a corrected row.

    Output: tripID, deviceID, the ``order`` columns, prev_speed, speed_delta,
    ``revision``. The row of a reading with the highest revision holds;
    ``latest_revision`` takes it. Whatever the order of arrival, these rows equal the
    batch ``lag`` for every reading that is at most ``lateness`` older than
    the newest its trip had sent in earlier micro-batches; older ones come
    with revision -1 and no delta. A trip keeps the readings of that
    span and one before it, so it is bounded by the sampling rate; with
    ``idle_timeout`` it goes when the trip has sent nothing for so long. The
    trips are dealt to ``STATE_KEYS`` state keys (see ``stream_speed_delta``)."""
    order = list(order)
    if "speed" not in order:
        raise ValueError("the order columns must hold speed")
    span = _interval_us(lateness)

    def step(new: pd.DataFrame, kept: pd.DataFrame | None) -> tuple[pd.DataFrame, pd.DataFrame]:
        new = new.drop(columns=order[0]).assign(revision=0)
        known = 0 if kept is None else len(kept)
        rows = new if kept is None else pd.concat([kept.drop(columns="_seen"), new], ignore_index=True)
        speed = _speeds(rows)
        (places, before, revisions), keep, kept_revisions = merge_trips(
            rows["_trip"].to_numpy(), rows["_t"].to_numpy(), _sort_keys(rows, order[1:], True), speed, rows["revision"].to_numpy(),
            np.arange(len(rows)) >= known, span)
        out = rows.iloc[places].assign(prev_speed=before, speed_delta=speed[places] - before, revision=revisions)
        out[order[0]] = out["_t"].to_numpy().view("datetime64[us]")
        return out, rows.iloc[keep].assign(revision=kept_revisions)

    more = [StructField("prev_speed", DoubleType()), StructField("speed_delta", DoubleType()), StructField("revision", LongType())]
    return _by_trip(readings, list(dict.fromkeys(TRIP + order)), order[0], more, idle_timeout, step)


def latest_revision(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Of each reading (``key`` names it) the row with the highest revision."""
    cols = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*cols), "revision").alias("_r"))
    return best.select(*key, "_r.*")


def _interval_us(text: str) -> int:
    n, unit = text.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit]
    return int(float(n) * mult * 1_000_000)


# --- X6: windowed alert counts -------------------------------------------------

def stream_alert_windows(readings: DataFrame, window: str = "1 day", watermark: str = "1 hour",
                         th: Thresholds = DEFAULTS) -> DataFrame:
    """Alert counts per device per tumbling event-time window.

    Contract: write it in append mode (``write_append_to_parquet``). A window
    is emitted once the watermark (the newest reading less ``watermark``)
    passes its end, and its state is dropped, so state stays bounded. A reading
    of a window already emitted is not counted; ``dropped_late`` tells how
    many there were. At the end of a bounded input a ``heartbeat`` moves the
    watermark on, so that the last windows come out too. Complete mode
    (``write_complete_to_parquet``) also shows open windows but keeps every
    window's state."""
    f = flags.with_vehicle_flags(readings.withColumn("timeStamp", F.col("timeStamp").cast("timestamp")), th)
    return (f.withWatermark("timeStamp", watermark)
             .groupBy(F.window("timeStamp", window).alias("w"), "deviceID")
             .agg(F.count(F.lit(1)).alias("readings"),
                  F.count_if("has_health_alert").alias("alert_rows"),
                  F.count_if("is_high_rpm").alias("high_rpm_count"),
                  F.count_if("is_overheating").alias("overheating_count"),
                  F.count_if("is_excessive_load").alias("excessive_load_count"),
                  F.count_if("is_low_battery").alias("low_battery_count"),
                  F.count_if("is_dtc_event").alias("dtc_count"))
             .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                     "deviceID", "readings", "alert_rows", "high_rpm_count", "overheating_count",
                     "excessive_load_count", "low_battery_count", "dtc_count"))


def heartbeat(schema: StructType, at, spark: SparkSession) -> DataFrame:
    """One reading without a device at time ``at``: closes the windows that end
    before it (its own window stays open and is never emitted)."""
    row = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return row.withColumn("timeStamp", F.lit(at).cast(schema["timeStamp"].dataType))


def dropped_late(query: StreamingQuery) -> int:
    """Readings not counted because their window was emitted already, over the
    progress reports that the query still keeps (the last 100 by default,
    ``spark.sql.streaming.numRecentProgressUpdates``)."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def write_complete_to_parquet(agg: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                              every: str = "30 seconds") -> StreamingQuery:
    """Complete-mode result, a whole Parquet table per micro-batch;
    ``readers.read_current`` takes the newest, which is there from its commit
    on, and the one before stays for readers that have begun."""
    def sink(batch: DataFrame, epoch: int) -> None:
        Landing(batch.sparkSession, out_path).add(batch.write.parquet, stream_id(batch.sparkSession, checkpoint), epoch, replace=True)

    return start(agg.writeStream.outputMode("complete").foreachBatch(sink)
                    .option("checkpointLocation", checkpoint), available_now, every)


def write_append_to_parquet(df: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                            every: str = "30 seconds") -> StreamingQuery:
    return start(df.writeStream.format("parquet").option("path", out_path)
                   .option("checkpointLocation", checkpoint).outputMode("append"), available_now, every)


# --- X7: keep the keyed snapshot current ---------------------------------------

def latest_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key: the one with the greatest ``order_col``."""
    cols = [c for c in df.columns]
    best = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(order_col)).alias("_r"))
    return best.select("_r.*")


def stream_upsert_scores(items: DataFrame, snapshot_base: str, checkpoint: str, key: str = "deviceID",
                         order_col: str = "processed_datestamp", available_now: bool = True,
                         every: str = "30 seconds") -> StreamingQuery:
    """Upsert every micro-batch of score items into the keyed snapshot.

    Each micro-batch becomes the next version and writes only the buckets of
    its items. The stream is known by its checkpoint's id: a retried epoch of
    the same checkpoint is written once. Items with a lesser ``order_col``
    never replace others, so files that arrive late cannot undo newer ones."""
    def sink(batch: DataFrame, epoch: int) -> None:
        keyed.upsert_snapshot(latest_per_key(batch, key, order_col), snapshot_base, key, order_col,
                              writer=stream_id(batch.sparkSession, checkpoint), epoch=epoch)

    return start(items.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint), available_now, every)
