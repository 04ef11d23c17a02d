"""Sharding by weighted rendezvous hashing, with DataFrame operations only.

Every shard draws, from a hash of the record's key and its own number, an
exponential waiting time whose rate is the shard's weight; the record goes to
the shard that comes first. A shard's draws depend on no other shard, so a new
shard takes only the records it wins, one that goes leaves only its own, and a
greater weight only draws records in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import Scratch, column_names, table

SHARDS = 24
#: Bytes that a record takes besides its text.
HEADER = 8
SEED = "shard-1"
DIGITS = 13  # hex digits of a draw, 52 bits: exact in a double


def waiting(key: Column, shard: int, weight: float, seed: str = SEED) -> Column:
    """The shard's waiting time for the key."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{shard}:"), key)), 1, DIGITS), 16, 10).cast("double")
    return -F.ln((drawn + 0.5) / float(16 ** DIGITS)) / float(weight)


def winner(key: Column, weights: Sequence[float], seed: str = SEED) -> Column:
    """The shard (0 to len(weights) - 1) of a string key; ties go to the smaller
    number, shards of weight 0 get nothing. Null keys are the empty key."""
    if not any(w > 0 for w in weights):
        raise ValueError("no shard has a weight above 0")
    known = F.coalesce(key, F.lit(""))
    return F.array_min(F.array(*(F.struct(waiting(known, n, w, seed).alias("t"), F.lit(n).alias("shard"))
                                 for n, w in enumerate(weights) if w > 0)))["shard"]


def shard_records(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown: Sequence[float] | None = None,
                  key: str = "doc_id", seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: key, size (UTF-8 bytes of the text plus
    HEADER), text_crc32 (unsigned; a null text has no bytes, so 0), law
    ('key'), shard, slot (from 0 without gaps in each shard, by key, size and
    text_crc32, null keys first) and grown_shard (the shard under the weights
    ``grown``, by default one more shard of the mean weight).

    The key and the weights alone decide the shard, so rows of one key, null
    included, and repeated rows share a shard. Slots come from one range
    exchange of short rows and one count per range and shard, so no shard has
    to fit a task. An empty table gives no rows; further columns are ignored."""
    scratch = Scratch(docs.sparkSession, "shards")
    later = tuple(grown) if grown is not None else (*weights, sum(weights) / len(weights))
    text = F.coalesce("text", F.lit(""))
    name = F.col(f"`{key}`").cast("string")
    drawn = scratch.save(column_names(docs, key, "text").select(
        F.col(f"`{key}`").alias("key"), (F.octet_length(text) + HEADER).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        winner(name, weights, seed).alias("shard"), winner(name, later, seed).alias("grown_shard")))
    order = ["shard", "key", "size", "text_crc32"]
    ranged = scratch.save(drawn.repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()))
    # one row per range and shard: at most ranges + shards rows, which is the bound of this broadcast
    counted = ranged.groupBy("part", "shard").agg(F.count("*").alias("n"), F.min("nth").alias("first"))
    carried = counted.select("part", "shard", (F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("first")).alias("shift"))
    return (ranged.join(F.broadcast(carried), ["part", "shard"])
            .select(F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("nth") + F.col("shift")).alias("slot"), "grown_shard"))


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * SHARDS, key: str = "doc_id",
                 seed: str = SEED) -> None:
    """The rows of ``docs`` as Parquet below ``path/shard=N``. Ranges of (shard,
    hash of the key and text) go to one task each, so a large shard has
    several files and rows of one key can part; a shard is its whole folder.
    A column named shard gives way."""
    spread = F.xxhash64(F.col(f"`{key}`"), F.col("text"))
    sharded = docs.withColumn("shard", winner(F.col(f"`{key}`").cast("string"), weights, seed))
    sharded.repartitionByRange("shard", spread).write.partitionBy("shard").parquet(path)


def op12_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_records(table(spark, sf_dir, "documents"))
