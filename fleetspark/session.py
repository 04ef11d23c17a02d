"""Session helpers: building a session and locating the checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Time zone (batch stamps and parsed times depend on it) and adaptive execution.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "fleetspark", extra: dict | None = None) -> SparkSession:
    """Session with the settings the engine relies on (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config(map=SESSION_SETTINGS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is used
    as is. Only a local-mode session without the setting (tests, laptops) gets
    a fresh private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared "
            "checkpoint folder (e.g. on the distributed file system)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="fleetspark-ckpt-"))
    return sc.getCheckpointDir()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable (shared-storage) checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a Parquet table in the shared folder, where several
    scans of a few columns follow."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint_with_count(df: DataFrame) -> tuple[DataFrame, int]:
    """Reliable checkpoint plus the row count, gathered by the checkpoint job
    itself (an observation), so no second pass counts the rows."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    obs = Observation("checkpoint_rows")
    out = reliable_checkpoint(df.observe(obs, F.count(F.lit(1)).alias("n")))
    return out, int(obs.get["n"])


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables under the shared checkpoint
    folder (never a machine-local temp folder on a cluster). It is removed
    when the driver ends; checkpoints go when nothing refers to them any more
    (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/work/{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is not None and not sc._jsc.sc().isStopped():
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (one metadata call)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def tune_for_input(spark: SparkSession, nbytes: int, partition_bytes: int = 256 << 20,
                   min_partitions: int | None = None) -> int:
    """Size scan splits and shuffle partitions for an input of ``nbytes``.

    Scan splits and AQE's target shuffle partition are set to
    ``partition_bytes`` so a task's share fits executor memory without
    spilling much; the initial shuffle partition count is the input size
    over that (at least the cluster's default parallelism) and AQE coalesces
    it down at runtime or splits skewed partitions. Returns the count."""
    sc = spark.sparkContext
    floor = min_partitions if min_partitions is not None else sc.defaultParallelism
    n = max(floor, -(-nbytes // partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
