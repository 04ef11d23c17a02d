"""Shared helpers: reading tables, intermediate tables, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import ClassVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.session import work_path

ARROW_ROWS = 1000
ARROW_BYTES = 4 << 20


class WorkerCache(dict):
    """What a Python worker remembers for one operator, bounded by bytes (as
    told with ``spend``). Spark reuses workers for later stages: the operator
    that claims its cache empties those of all others in the process."""
    made: ClassVar[list[WorkerCache]] = []

    def __init__(self, most_bytes: int):
        super().__init__()
        self.most_bytes, self.bytes = most_bytes, 0
        WorkerCache.made.append(self)

    def empty(self) -> None:
        self.clear()
        self.bytes = 0

    def claim(self) -> WorkerCache:
        for other in WorkerCache.made:
            if other is not self and other:
                other.empty()
        return self

    def spend(self, n: int) -> None:
        """Account ``n`` further bytes; a cache beyond its bound starts again."""
        if self.bytes + n > self.most_bytes:
            self.empty()
        self.bytes += n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package. Where they find it anyway
    (PYTHONPATH, the working folder) nothing happens; else it goes to them as
    a zip file, once per session."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    there = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if getattr(sc, "_fleetspark_shipped", False) or any(x and Path(x).resolve() == root for x in there):
        return
    path = Path(tempfile.mkdtemp(prefix="fleetspark-")) / "fleetspark_package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "fleetspark").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(path))
    sc._fleetspark_shipped = True


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Send whole texts to Python in batches of at most ``rows`` and about
    ARROW_BYTES (or one row), so that a run of very long texts cannot fill a
    worker's memory. Changes no result."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str, rows: int = ARROW_ROWS) -> DataFrame:
    """``fn`` turns the columns of one Arrow batch (at most ``rows`` rows,
    about ARROW_BYTES) into output columns."""
    small_batches(df.sparkSession, rows)
    out = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
            yield pa.RecordBatch.from_arrays(
                [v if isinstance(v, pa.Array) else pa.array(v, f.type)
                 for f, v in ((f, cols[f.name]) for f in out)], schema=out)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


class Scratch:
    """Intermediate Parquet tables below the cluster's shared checkpoint folder.

    A written table cuts lineage: a lost executor costs at most the running
    step. ``drop`` removes a table that no later step reads; what the result
    still reads goes when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        ship_package(spark)
        self.spark, self.root, self.n = spark, work_path(spark, name), 0

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def words_pattern() -> str:
    """A word: a maximal run without space and without \\x09 to \\x0D."""
    return r"[^\x20\x09-\x0D]+"


def column_names(df: DataFrame, *wanted: str) -> DataFrame:
    """Only the wanted columns, so that further ones cannot clash."""
    return df.select(*[F.col(f"`{c}`") for c in wanted])
