"""Q2 / Q3 / J3 kept current from new batches (no history is read again).

Three keyed tables hold what scoring needs: per device mergeable sums and
counts; per device and 64 neighbouring trip ids one word of bits, so that
distinct trips merge by ``bit_or``; and per trip its last reading, the
predecessor of the next batch's first one. A batch reads and writes only the
buckets of its own devices and trips.

The device table is the master: its commit names the versions of the other two
that it was computed with, so a batch that failed half-way is computed anew
from the same versions, and tables that had it already keep it once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULTS, Thresholds
from ..functions import flags
from ..operators import ranking, windows
from ..schema import DRIVER_COLUMNS, VEHICLE_COLUMNS
from ..session import reliable_checkpoint
from ..sinks.keyed import KeyedTable
from .analytics import DRIVER_TIEBREAK, driver_scores, vehicle_scores

#: Counted flags by measure; averaged columns by measure (moving: where the speed is above 0).
COUNTS = {"high_rpm_count": "is_high_rpm", "rapid_accel_count": "is_rapid_accel", "hard_brake_count": "is_hard_brake",
          "aggressive_event_count": "is_aggressive_event", "overheating_count": "is_overheating",
          "excessive_load_count": "is_excessive_load", "low_battery_count": "is_low_battery", "dtc_count": "is_dtc_event",
          "total_alert_count": "has_health_alert"}
MEANS = {"avg_kpl_while_moving": "moving_kpl", "avg_speed": "speed", "avg_rpm": "rpm", "avg_cTemp": "cTemp", "avg_eLoad": "eLoad"}
READING = ["tripID", "deviceID", "timeStamp", "speed", "rpm", "kpl"]
WRITER = "batches"


def _added(*names: str):
    """Merge of two device states: every measure is a sum."""
    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.unionByName(new)
        return both.groupBy("deviceID").agg(*[F.sum(c).alias(c) for c in names])
    return merge


def _words(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy("word_key").agg(F.first("deviceID").alias("deviceID"), F.expr("bit_or(bits)").alias("bits"))


def _last(rows: DataFrame) -> DataFrame:
    """The last reading of each trip, in the order the driver job uses."""
    return (rows.groupBy("trip_key").agg(F.max(F.struct("timeStamp", *DRIVER_TIEBREAK)).alias("at"),
                                         F.first("tripID").alias("tripID"), F.first("deviceID").alias("deviceID"))
            .select("trip_key", "tripID", "deviceID", "at.*"))


class FleetState:
    """The states of a fleet below ``base``. Batches come in order of time
    within each trip, as uploads of a trip do; a reading older than its trip's
    last one gets its delta within its own batch only. Event counts follow the
    "fixed" null policy."""

    def __init__(self, spark: SparkSession, base: str, th: Thresholds = DEFAULTS, buckets: int = 8):
        base = base.rstrip("/")
        self.spark, self.th = spark, th
        self.devices = KeyedTable(spark, f"{base}/devices", "deviceID", buckets)
        self.trips = KeyedTable(spark, f"{base}/trips", "word_key", buckets)
        self.tails = KeyedTable(spark, f"{base}/tails", "trip_key", buckets)

    def apply(self, batch: DataFrame, number: int) -> bool:
        """Add the readings of batch ``number`` (0, 1, ...); False if it was
        added before."""
        if number <= self.devices.applied(WRITER):
            return False
        note = self.devices.note()
        old_words, old_tails = (self._pinned(t, note.get(n)) for n, t in (("trips", self.trips), ("tails", self.tails)))
        trip_key = F.to_json(F.struct("tripID", "deviceID"))
        rows = batch.select(*READING, "cTemp", "eLoad", "battery", "dtc").withColumn("trip_key", trip_key)

        own = rows.withColumn("_known", F.lit(False))
        if old_tails is not None:
            before = old_tails.join(rows.select("trip_key").distinct(), "trip_key", "left_semi").withColumn("_known", F.lit(True))
            own = own.unionByName(before, allowMissingColumns=True)
        deltas = windows.with_speed_delta(own, self.th, tiebreak=DRIVER_TIEBREAK).filter(~F.col("_known"))
        flagged = (flags.with_vehicle_flags(flags.with_driver_flags(deltas, self.th), self.th)
                   .withColumn("moving_kpl", F.when(F.col("speed") > 0, F.col("kpl"))))
        measures = flagged.groupBy("deviceID").agg(
            F.count(F.lit(1)).alias("total_readings"), *[F.count_if(F.col(f)).alias(c) for c, f in COUNTS.items()],
            *[x for m, c in MEANS.items() for x in (F.coalesce(F.sum(c), F.lit(0.0)).alias(f"sum_{m}"), F.count(c).alias(f"n_{m}"))])

        word = F.shiftright(F.col("tripID").cast("long"), 6)
        words = (rows.filter("tripID IS NOT NULL").groupBy("deviceID", word.alias("word"))
                 .agg(F.expr("bit_or(shiftleft(1L, cast(tripID & 63 AS INT)))").alias("bits"))
                 .select(F.to_json(F.struct("deviceID", "word")).alias("word_key"), "deviceID", "bits"))
        had = F.lit(0).cast("long")
        met = words
        if old_words is not None:
            met = words.join(old_words.select("word_key", F.col("bits").alias("old_bits")), "word_key", "left")
            had = F.coalesce("old_bits", F.lit(0).cast("long"))
        fresh = met.groupBy("deviceID").agg(F.sum(F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(had)))).alias("total_trips"))
        states = (measures.join(fresh.withColumnRenamed("deviceID", "_device"), F.col("deviceID").eqNullSafe(F.col("_device")), "left")
                  .drop("_device").withColumn("total_trips", F.coalesce("total_trips", F.lit(0).cast("long"))))
        states = reliable_checkpoint(states)  # one row per device of the batch

        trips = self.trips.combine(words, _words, WRITER, number)
        tails = self.tails.combine(_last(rows), lambda old, new: _last(old.unionByName(new)), WRITER, number)
        sums = [c for c in states.columns if c != "deviceID"]
        self.devices.combine(states, _added(*sums), WRITER, number, {"trips": trips.version, "tails": tails.version})
        return True

    @staticmethod
    def _pinned(table: KeyedTable, version: int | None) -> DataFrame | None:
        return None if version is None else table.read(version)

    def measures(self) -> DataFrame:
        """The A4 and A5 measures of every device so far."""
        state = self.devices.read()
        if state is None:
            raise FileNotFoundError("no batch has been applied")
        return state.select("deviceID", "total_readings", "total_trips", *COUNTS, *[
            F.when(F.col(f"n_{m}") > 0, F.col(f"sum_{m}") / F.col(f"n_{m}")).alias(m) for m in MEANS])

    def driver_performance(self) -> DataFrame:
        return ranking.driver_rank(driver_scores(self.measures(), self.th)).select(*DRIVER_COLUMNS)

    def vehicle_health(self) -> DataFrame:
        return ranking.risk_rank(vehicle_scores(self.measures(), self.th)).select(*VEHICLE_COLUMNS)
