"""Batch discovery and storage notifications.

Batches are folders or single objects named ``<prefix>_<yyyyMMdd_HHmmss>``.
One listing of the first level finds them (names only, never the files of a
batch); the stamp is pulled with ``regexp_extract`` and the latest chosen with
``max_by``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.stamps import extract_datestamp


def batch_paths(spark: SparkSession, base: str, prefix: str = "") -> DataFrame:
    """Finished batches directly under ``base`` (optionally starting with
    ``prefix``) as one ``path`` column: folders that hold ``_SUCCESS``, and
    single objects. Folders that are still being written, and hidden names,
    are left out."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    if fs.exists(p):
        # two listings, however many batches: the first level, and the marks of finished ones
        marks = fs.globStatus(jvm.org.apache.hadoop.fs.Path(p, "*/_SUCCESS")) or []
        finished = {st.getPath().getParent().getName() for st in marks}
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith(prefix) and not name.startswith(("_", ".")) and (name in finished or not st.isDirectory()):
                found.append((st.getPath().toString(),))
    return spark.createDataFrame(found, "path string")


def list_batches(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Batches with their stamp, newest first (paths without a stamp are
    left out)."""
    return (paths.select(F.col(path_col).alias("path"),
                         extract_datestamp(F.col(path_col)).alias("datestamp"))
                 .filter(F.col("datestamp").isNotNull())
                 .orderBy(F.col("datestamp").desc(), F.col("path").desc()))


def latest_batch(paths: DataFrame, path_col: str = "path", strict: bool = True) -> DataFrame:
    """The newest batch as one row (datestamp, path); with ``strict`` the
    query fails when no path carries a stamp."""
    stamped = paths.select(F.col(path_col).alias("path"),
                           extract_datestamp(F.col(path_col)).alias("datestamp"))
    best = stamped.agg(F.max("datestamp").alias("datestamp"),
                       F.max_by("path", F.struct("datestamp", "path")).alias("path"))
    if strict:
        best = best.withColumn(
            "datestamp",
            F.when(F.col("datestamp").isNull(), F.raise_error(F.lit("no stamped batch found")))
             .otherwise(F.col("datestamp")))
    return best


def latest_batch_path(spark: SparkSession, base: str, prefix: str = "") -> tuple[str, str]:
    """(datestamp, path) of the newest batch under ``base``; one tiny result
    row comes back to the driver to name the folder to read next."""
    row = latest_batch(batch_paths(spark, base, prefix)).first()
    return row["datestamp"], row["path"]


NOTIFICATION_SCHEMA = StructType([
    StructField("Records", ArrayType(StructType([
        StructField("s3", StructType([
            StructField("bucket", StructType([StructField("name", StringType())])),
            StructField("object", StructType([StructField("key", StringType())])),
        ])),
    ]))),
])


def parse_file_events(df: DataFrame, col: str = "value") -> DataFrame:
    """Storage notification JSON → (bucket, key) of each of its records.
    A malformed or foreign message yields no row."""
    ev = F.from_json(F.col(col).cast("string"), NOTIFICATION_SCHEMA)
    records = df.select(F.explode(ev["Records"]).alias("r"))
    out = records.select(F.col("r.s3.bucket.name").alias("bucket"), F.col("r.s3.object.key").alias("key"))
    return out.filter(F.col("bucket").isNotNull() & F.col("key").isNotNull())
