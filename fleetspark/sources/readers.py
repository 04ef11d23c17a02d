"""Readers (S1-S5, S8, S10-S12).

Raw readings are read with the declared all-string schema (no inference):
JSON numbers arrive as their text, missing keys as null, extra keys are
ignored, and a line that is not a reading becomes an all-null row that the
malformed filter drops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..commits import Landing
from ..schema import RAW_COLUMNS, RAW_SCHEMA
from ..sinks import keyed
from ..sinks.writers import micros_column


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line; every field a string. Columns go by the
    header's names, in any order: a missing one is null, further ones are
    ignored. Files of one folder must agree on their header (others fail
    instead of being read wrongly). Header lines repeated inside the data
    (concatenated files) stay in as rows."""
    found = (spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
                  .option("mode", "PERMISSIVE").csv(path))
    return found.select(*[(F.col(f"`{c}`") if c in found.columns else F.lit(None).cast("string")).alias(c)
                          for c in RAW_COLUMNS])


def read_raw_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the declared all-string schema: the files below
    ``path``, or, where a stream lands there, those of its finished
    micro-batches."""
    landing = Landing(spark, path)
    paths = landing.folders() if landing.started() else path
    return spark.read.schema(RAW_SCHEMA).option("mode", "PERMISSIVE").json(paths)


#: The column that holds a line which is no reading.
UNREADABLE = "_unreadable"


def read_raw_jsonl_with_lines(spark: SparkSession, path: str) -> DataFrame:
    """S2 for a quarantine: the raw columns, and the whole line where it is no
    reading (null elsewhere)."""
    landing = Landing(spark, path)
    schema = StructType([*RAW_SCHEMA.fields, StructField(UNREADABLE, StringType())])
    return (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", UNREADABLE)
                 .json(landing.folders() if landing.started() else path))


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole result that ``write_complete_to_parquet`` keeps at ``path``."""
    folders = Landing(spark, path).folders()
    if not folders:
        raise FileNotFoundError(f"no result at {path}")
    return spark.read.parquet(*folders)


def parse_raw_json(df: DataFrame, col: str = "value") -> DataFrame:
    """S3: decode a JSON string column (e.g. a Kafka value) into the raw columns."""
    parsed = F.from_json(F.col(col).cast("string"), RAW_SCHEMA)
    return df.select(parsed.alias("_r")).select(*[F.col("_r")[c].alias(c) for c in RAW_COLUMNS])


def read_clustered(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> DataFrame:
    """S5 for a batch of ``writers.write_clustered``: the rows whose columns lie
    in half-open ``ranges`` (column: least value, first value beyond; null for
    no bound). Only row groups that can hold such rows are read."""
    df = spark.read.parquet(path)
    for c, (low, high) in ranges.items():
        helper = micros_column(c)
        for column, cast in ((F.col(c), lambda v, k=dict(df.dtypes)[c]: F.lit(v).cast(k)),
                             *([(F.col(helper), lambda v: F.unix_micros(F.lit(v).cast("timestamp")))] if helper in df.columns else [])):
            if low is not None:
                df = df.filter(column >= cast(low))
            if high is not None:
                df = df.filter(column < cast(high))
    return df.drop(*[micros_column(c) for c in df.columns])


def read_batch(spark: SparkSession, path: str) -> DataFrame:
    """One processed / curated batch (Parquet)."""
    return spark.read.parquet(path)


def batch_partitions(spark: SparkSession, base: str, column: str = "batch") -> list[str]:
    """Batch values of a partitioned layout, newest first (folder names only:
    one metadata listing, no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted((n[len(prefix):] for n in names if n.startswith(prefix)), reverse=True)


def read_batch_partition(spark: SparkSession, base: str, stamp: str | None = None,
                         column: str = "batch") -> DataFrame:
    """S5, partitioned layout: one batch (the newest when ``stamp`` is None).
    Its folder alone is listed and read; the batch column stays."""
    if stamp is None:
        found = batch_partitions(spark, base, column)
        if not found:
            raise FileNotFoundError(f"no {column}= partitions under {base}")
        stamp = found[0]
    one = spark.read.option("basePath", base).parquet(f"{base.rstrip('/')}/{column}={stamp}")
    return one.withColumn(column, F.lit(stamp))


def list_raw_objects(spark: SparkSession, base: str, pattern: str = "*") -> DataFrame:
    """Object keys under ``base`` with size and modification time.

    Uses the binary-file source with only metadata columns selected, so file
    contents are never read; the listing itself is done by Spark's file index
    (parallel for large folders)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
                 .option("recursiveFileLookup", True).load(base)
                 .select("path", "length", "modificationTime"))


def read_serving_table(spark: SparkSession, url: str, table: str,
                       properties: dict | None = None, rows_per_partition: int = 500_000) -> DataFrame:
    """Full JDBC read of a serving table, ordered by deviceID.

    The read is split on deviceID, into as many parts as the row count needs."""
    props = dict(properties or {})
    bounds = (spark.read.jdbc(url, f"(SELECT MIN(deviceID) AS lo, MAX(deviceID) AS hi, COUNT(*) AS n FROM {table}) b",
                              properties=props).first())
    if bounds is None or bounds["lo"] is None:
        return spark.read.jdbc(url, table, properties=props).orderBy("deviceID")
    return (spark.read.jdbc(url, table, column="deviceID", lowerBound=int(bounds["lo"]),
                            upperBound=int(bounds["hi"]) + 1,
                            numPartitions=max(1, -(-int(bounds["n"]) // rows_per_partition)),
                            properties=props)
                 .orderBy("deviceID"))


def read_keyed_snapshot(spark: SparkSession, path: str, decimal_cols: list[str] | None = None) -> DataFrame:
    """Full scan of the keyed table at ``path``, ordered by deviceID;
    4-place decimals come back as plain numbers (C16)."""
    df = keyed.read_snapshot(spark, path)
    if df is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    dec = decimal_cols if decimal_cols is not None else [
        f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"]
    if dec:
        df = df.withColumns({c: F.col(c).cast("double") for c in dec})
    return df.orderBy(F.col("deviceID").cast("long"))


def sample_rows(df: DataFrame, n: int = 1000, order: list[Column | str] | None = None) -> DataFrame:
    """The first ``n`` rows by a key (a sampling feature; deterministic
    through the ordering, executed as a per-task top-n)."""
    if order:
        df = df.orderBy(*order)
    return df.limit(n)
