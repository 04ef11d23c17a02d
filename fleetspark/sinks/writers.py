"""Writers (K1-K6, K9, K13).

All writes go through the DataFrame writer, so each task writes its own part
file and the job commits atomically (``_SUCCESS`` marks a finished batch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import CURATED_BATCH, PROCESSED_BATCH, RAW_BATCH, REPORT_BATCH

PROCESSED = "PROCESSED"
SKIPPED = "SKIPPED_ALREADY_PROCESSED"


def raw_batch_path(base: str, stamp: str) -> str:
    return f"{base.rstrip('/')}/" + RAW_BATCH.format(stamp=stamp)


def processed_batch_path(base: str, stamp: str) -> str:
    return f"{base.rstrip('/')}/" + PROCESSED_BATCH.format(stamp=stamp)


def curated_path(base: str, uc: str, name: str, stamp: str) -> str:
    return f"{base.rstrip('/')}/" + CURATED_BATCH.format(uc=uc, name=name, stamp=stamp)


def report_path(base: str, report: str, name: str, stamp: str) -> str:
    return f"{base.rstrip('/')}/" + REPORT_BATCH.format(report=report, name=name, stamp=stamp)


def write_raw_jsonl(df: DataFrame, base: str, stamp: str) -> str:
    """K1: one JSON object per line into the stamped raw batch folder."""
    path = raw_batch_path(base, stamp)
    df.write.mode("overwrite").json(path)
    return path


def kafka_payload(df: DataFrame, key: Column | None = None) -> DataFrame:
    """K2 payload: each row as a JSON object in ``value`` (null fields left
    out), optional ``key``."""
    cols = [F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")]
    if key is not None:
        cols.insert(0, key.cast("string").alias("key"))
    return df.select(*cols)


def write_kafka(df: DataFrame, servers: str, topic: str, compression: str = "gzip") -> None:
    """K2: publish rows to a topic (needs the Kafka connector on the classpath)."""
    (kafka_payload(df).write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.compression.type", compression)
        .option("topic", topic).save())


def write_batch(df: DataFrame, path: str) -> str:
    """K3: Parquet overwrite of one batch."""
    df.write.mode("overwrite").parquet(path)
    return path


def _bucket(value: Column, bounds: list[float]) -> Column:
    """How many of the ascending bounds are at most ``value`` (null: 0), as a
    balanced tree of comparisons."""
    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(value < F.lit(bounds[mid]), tree(low, mid)).otherwise(tree(mid + 1, high))
    return F.when(value.isNull(), F.lit(0)).otherwise(tree(0, len(bounds)))


def interleaved(columns: list[Column], bits: int) -> Column:
    """The bits of several small numbers in turn (Z order), highest first."""
    out = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for c in columns:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(c.cast("long"), bit).bitwiseAND(F.lit(1)))
    return out


def write_clustered(df: DataFrame, path: str, by: tuple[str, ...] = ("deviceID", "timeStamp"), files: int = 32,
                    bits: int = 6, accuracy: int = 10_000) -> str:
    """K3 with clusters: rows near each other in all of ``by`` (numbers or
    times) share files, so that the footers' least and greatest values let a
    reader skip the others, whichever of the columns it filters.

    Each column is cut at 2 ** ``bits`` - 1 of its approximate quantiles (one
    aggregate; only these come to the driver), the cells are ordered by their
    interleaved bits and the rows range-partitioned by cell, then by the
    columns, so that a cell or a device of any size is split over ``files``
    (name the batch's bytes over 128 MB). ``readers.read_clustered`` reads it."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    number = {c: (F.unix_micros(F.col(c).cast("timestamp")) if dict(df.dtypes)[c].startswith("timestamp") else F.col(c)).cast("double")
              for c in by}
    row = df.agg(*[F.percentile_approx(number[c], shares, accuracy).alias(c) for c in by]).first()
    cell = interleaved([_bucket(number[c], sorted(set(row[c] or []))) for c in by], bits)
    order = ["_cell", *by]
    times = {micros_column(c): F.unix_micros(F.col(c).cast("timestamp")) for c in by if dict(df.dtypes)[c].startswith("timestamp")}
    (df.withColumns({"_cell": cell, **times}).repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_cell")
       .write.mode("overwrite").parquet(path))
    return path


def micros_column(name: str) -> str:
    """The column that holds a time as whole microseconds: filters on times
    without zone do not reach the footers, on whole numbers they do."""
    return f"_{name}_us"


def write_batch_partition(df: DataFrame, base: str, stamp: str | Column, column: str = "batch") -> str:
    """K3, partitioned layout: ``base/batch=<stamp>/``. ``stamp`` is one value
    or a per-row column (one partition per value). Only the partitions written
    are replaced (dynamic partition overwrite). Rows are rebalanced by batch
    first, so a batch gets as many files as its size needs instead of one per
    task, and a very large batch is split."""
    value = stamp if isinstance(stamp, Column) else F.lit(stamp)
    (df.withColumn(column, value).hint("rebalance", column).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(base))
    return base if isinstance(stamp, Column) else f"{base.rstrip('/')}/{column}={stamp}"


def write_curated_and_report(df: DataFrame, curated: str, report: str) -> tuple[str, str]:
    """K4: the same result to the curated and the report folders.

    The result is computed and written once; the report copy is made from the
    written curated files, so the analytics plan never runs twice."""
    write_batch(df, curated)
    df.sparkSession.read.parquet(curated).write.mode("overwrite").parquet(report)
    return curated, report


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a finished write (``_SUCCESS``) exists at ``path``."""
    fs, p = _fs_path(spark, path.rstrip("/") + "/_SUCCESS")
    return bool(fs.exists(p))


def mark_complete(spark: SparkSession, path: str) -> None:
    """Put ``_SUCCESS`` into a folder that a stream has finished writing."""
    fs, p = _fs_path(spark, path.rstrip("/") + "/_SUCCESS")
    fs.create(p, True).close()


def write_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """K5: skip a batch that was already written completely; a half-written
    folder (no ``_SUCCESS``) is overwritten."""
    if is_complete(df.sparkSession, path):
        return SKIPPED
    df.write.mode("overwrite").format(fmt).save(path)
    return PROCESSED


def write_serving_table(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """K6: replace a relational serving table's rows, keeping its DDL."""
    props = dict(properties or {})
    props.setdefault("truncate", "true")
    df.write.jdbc(url, table, mode="overwrite", properties=props)


def with_load_metadata(df: DataFrame, stamp: str | Column, loaded_at: Column | None = None) -> DataFrame:
    """processed_datestamp and loaded_at (load time unless given)."""
    st = stamp if isinstance(stamp, Column) else F.lit(stamp)
    return df.withColumns({
        "processed_datestamp": st,
        "loaded_at": loaded_at if loaded_at is not None else F.current_timestamp(),
    })


def ensure_table(spark: SparkSession, name: str, schema: StructType, location: str,
                 key: str = "deviceID") -> str:
    """K9: create the serving table if it does not exist (typed columns,
    Parquet at ``location``). The key is documented in the table properties;
    ``duplicate_keys`` checks it."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"LOCATION '{location}' TBLPROPERTIES ('primary_key' = '{key}')")
    return name


def duplicate_keys(df: DataFrame, key: str = "deviceID") -> DataFrame:
    """Keys that occur more than once (empty for a valid keyed table)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
