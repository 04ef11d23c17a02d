"""Keyed tables: the key-value serving store on files.

A keyed table is dealt into hash buckets; a commit file names the folder of
each bucket (``fleetspark.commits``), so a reader never sees a half-written
version and an upsert reads and writes only the buckets its keys fall in. It
is a join and a union on the executors; the driver handles bucket numbers and
folder names, never rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..commits import CommitLog
from ..functions.scores import round4_decimal


def upsert_keyed(old: DataFrame, new: DataFrame, key: str = "deviceID",
                 order_col: str | None = None) -> DataFrame:
    """K7: put-item by key - new rows replace old ones with the same key, old
    keys absent from ``new`` survive. Columns align by name; attributes
    missing on one side are null.

    With ``order_col`` (a batch stamp) the row with the greater stamp wins
    whichever side it is on, and the new one among equals, so input that
    arrives out of order cannot bring back older items."""
    if order_col is None:
        keep = old.join(new.select(key), on=key, how="left_anti")
        return keep.unionByName(new, allowMissingColumns=True)
    both = (old.withColumn("_new", F.lit(0))
               .unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True))
    cols = [c for c in both.columns if c != "_new"]
    best = both.groupBy(F.col(key).alias("_key")).agg(
        F.max_by(F.struct(*cols), F.struct(order_col, "_new")).alias("_row"))
    return best.select("_row.*")


#: Buckets of a new table (right for some 1 GB; a larger one names its bytes over 128 MB), versions that
#: readers can still open, times that a write merges anew after others.
BUCKETS, KEEP, TRIES = 8, 8, 20


@dataclass(frozen=True)
class Commit:
    """What a write did: version, its commit file, buckets and bytes written."""
    version: int
    path: str
    buckets: tuple[int, ...]
    bytes_written: int


class KeyedTable:
    """A table of one row per key, dealt by the key's hash into buckets.

    A commit names a folder for each bucket that has rows, so a write that
    touches some buckets names new folders for those and the old ones for all
    others. Rows of a write are staged by bucket once; a bucket without old rows
    takes its staged folder as it is. Versions older than the last ``keep`` are
    removed together with the folders that only they name."""

    def __init__(self, spark: SparkSession, base: str, key: str = "deviceID", buckets: int = BUCKETS, keep: int = KEEP):
        self.spark, self.base, self.key, self.buckets, self.keep = spark, base.rstrip("/"), key, buckets, max(1, keep)
        self.log = CommitLog(spark, base)
        self.files = self.log.files

    # reading

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version (the newest by default), None before the first."""
        numbers = self.log.numbers()
        if version is None and not numbers:
            return None
        return self._rows(self.log.read(numbers[-1] if version is None else version))

    def _rows(self, state: dict, only: list[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(state["schema"])
        folders = [state["folders"][b] for b in (sorted(state["folders"]) if only is None else only)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.base}/{f}" for f in folders))

    # writing

    def upsert(self, new: DataFrame, order_col: str | None = None, writer: str | None = None, epoch: int = 0) -> Commit:
        """Put the rows of ``new`` (one per key) by key, as ``upsert_keyed`` does;
        only buckets that their keys fall in are read and written. A stream
        names itself (``writer``) and its ``epoch``; an epoch that a commit has
        applied is not applied again. If another writer commits first, the
        touched buckets are merged anew over its version."""
        return self._write(new, lambda old, fresh: upsert_keyed(old, fresh, self.key, order_col), writer, epoch)

    def combine(self, new: DataFrame, merge, writer: str | None = None, epoch: int = 0, note: dict | None = None) -> Commit:
        """Like ``upsert``, but ``merge(old rows, new rows)`` of the touched
        buckets gives their rows (one per key). ``note`` is kept with the commit."""
        return self._write(new, merge, writer, epoch, note)

    def applied(self, writer: str) -> int:
        """The last epoch of a writer that the newest version holds, -1 before the first."""
        _, state = self.log.newest()
        return (state or {}).get("applied", {}).get(writer, -1)

    def note(self) -> dict:
        """The newest version's note."""
        _, state = self.log.newest()
        return (state or {}).get("note") or {}

    def replace(self, rows: DataFrame) -> Commit:
        """Make ``rows`` (one per key) the whole table."""
        return self._write(rows, None, None, 0)

    def truncate(self) -> Commit:
        """Remove all rows, keep the columns."""
        old = self.read()
        if old is None:
            raise FileNotFoundError(f"no keyed table at {self.base}")
        return self.replace(old.limit(0))

    def _bucket(self, n: int):
        return F.pmod(F.xxhash64(self.key), F.lit(n)).cast("int")

    def _stage(self, rows: DataFrame, folder: str, n: int) -> dict[str, str]:
        """Write rows by bucket; folder of each bucket that has some."""
        (rows.withColumn("_bucket", self._bucket(n)).repartition("_bucket").write.partitionBy("_bucket")
             .parquet(f"{self.base}/{folder}"))
        return {x.split("=")[1]: f"{folder}/{x}" for x in self.files.names(folder) if x.startswith("_bucket=")}

    def _write(self, new: DataFrame, merge, writer: str | None, epoch: int, note: dict | None = None) -> Commit:
        staged, stage, staged_n = None, f"data/{uuid.uuid4().hex}", None
        for _ in range(TRIES):
            number, state = self.log.newest()
            if state is not None and writer is not None and epoch <= state["applied"].get(writer, -1):
                return Commit(number, f"{self.base}/{self.log.name(number)}", (), 0)
            n = state["buckets"] if state is not None and merge is not None else self.buckets
            if staged is None or staged_n != n:
                stage = f"data/{uuid.uuid4().hex}"
                staged, staged_n = self._stage(new, stage, n), n
            folders = dict(state["folders"]) if state is not None and merge is not None else {}
            schema = StructType(list(new.schema.fields))
            if state is not None and merge is not None:
                known = StructType.fromJson(state["schema"])
                schema = StructType(list(known.fields) + [f for f in new.schema.fields if f.name not in known.names])
            both, unused, written = sorted(set(folders) & set(staged)), [], sum(self.files.size(f) for f in staged.values())
            folders |= staged
            if both:
                fresh = self.spark.read.schema(new.schema).parquet(*(f"{self.base}/{staged[b]}" for b in both))
                merged = self._stage(merge(self._rows(state, both), fresh).select(*schema.names), f"data/{uuid.uuid4().hex}", n)
                folders |= merged
                unused = [staged[b] for b in both]
                written += sum(self.files.size(f) for f in merged.values())
            applied = (state or {}).get("applied", {}) | ({writer: epoch} if writer is not None else {})
            if self.log.commit(number + 1, {"buckets": n, "schema": json.loads(schema.json()), "folders": folders,
                                            "applied": applied, "unused": unused, "note": note}):
                self._expire()
                return Commit(number + 1, f"{self.base}/{self.log.name(number + 1)}", tuple(sorted(map(int, staged))), written)
            # another writer's version came in between: what was merged is named by no commit
            for f in (merged.values() if both else ()):
                self.files.delete(f)
        raise RuntimeError(f"{self.base}: {TRIES} other writers committed first")

    def _expire(self) -> None:
        numbers = self.log.numbers()
        if len(numbers) <= self.keep:
            return
        named = {f for x in numbers[-self.keep:] for f in self.log.read(x)["folders"].values()}
        for number in numbers[:-self.keep]:
            state = self.log.read(number)
            for folder in {*state["folders"].values(), *state["unused"]} - named:
                self.files.delete(folder)
            self.log.forget(number)


def current_version_path(spark: SparkSession, base: str) -> str | None:
    """The newest commit file of a keyed table."""
    log = CommitLog(spark, base)
    numbers = log.numbers()
    return f"{base.rstrip('/')}/{log.name(numbers[-1])}" if numbers else None


def write_snapshot(df: DataFrame, base: str, key: str = "deviceID", buckets: int = BUCKETS) -> str:
    """Make ``df`` the whole keyed table at ``base``, as its next version."""
    return KeyedTable(df.sparkSession, base, key, buckets).replace(df).path


def read_snapshot(spark: SparkSession, base: str) -> DataFrame | None:
    return KeyedTable(spark, base).read()


def upsert_snapshot(new: DataFrame, base: str, key: str = "deviceID",
                    order_col: str | None = None, writer: str | None = None, epoch: int = 0) -> str:
    """Upsert ``new`` into the keyed table at ``base`` (``KeyedTable.upsert``)."""
    return KeyedTable(new.sparkSession, base, key).upsert(new, order_col, writer, epoch).path


def truncate_keyed(spark: SparkSession, base: str) -> str:
    """K8: delete all items but keep the structure - an empty next version
    with the current schema."""
    return KeyedTable(spark, base).truncate().path


def to_driver_score_items(df: DataFrame, stamp) -> DataFrame:
    """The 8 attributes of a driver-score item; scores as 4-place
    decimals. Null attributes stay null (``to_json`` leaves them out)."""
    st = stamp if not isinstance(stamp, str) else F.lit(stamp)
    return df.select(
        F.col("deviceID").cast("long").alias("deviceID"),
        round4_decimal("driver_safety_score").alias("driver_safety_score"),
        round4_decimal("fuel_efficiency_score").alias("fuel_efficiency_score"),
        F.col("driver_category").cast("string").alias("driver_category"),
        F.col("driver_rank").cast("long").alias("driver_rank"),
        F.col("total_trips").cast("long").alias("total_trips"),
        F.col("aggressive_event_count").cast("long").alias("aggressive_event_count"),
        st.alias("processed_datestamp"),
    )


def to_vehicle_alert_items(df: DataFrame, stamp) -> DataFrame:
    """The 7 attributes of a vehicle-alert item."""
    st = stamp if not isinstance(stamp, str) else F.lit(stamp)
    return df.select(
        F.col("deviceID").cast("long").alias("deviceID"),
        round4_decimal("vehicle_health_score").alias("vehicle_health_score"),
        F.col("is_high_risk").cast("boolean").alias("is_high_risk"),
        F.col("maintenance_recommendation").cast("string").alias("maintenance_recommendation"),
        F.col("risk_rank").cast("long").alias("risk_rank"),
        F.col("total_alert_count").cast("long").alias("total_alert_count"),
        st.alias("processed_datestamp"),
    )
