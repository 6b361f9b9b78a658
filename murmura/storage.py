"""Intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else one in the session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back.

    Cuts the lineage, survives lost executors, and unlike a cached row block lets later passes
    read only the columns they touch.
    """
    path = scratch_path(df.sparkSession, name)
    _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting for removing shuffle files at the end of a query instead of when the driver collects garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def releasing(df: DataFrame) -> Iterator[None]:
    """While a table is stored here, the shuffles that made it go as soon as it is there, since nothing reads them again."""
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(RELEASE, "false")
    conf.set(RELEASE, "true")
    try:
        yield
    finally:
        conf.set(RELEASE, before)


def _write(df: DataFrame, path: str) -> None:
    with releasing(df):
        df.write.option("compression", "zstd").parquet(path)


class Scratch:
    """Intermediate tables of one job, each of which goes as soon as the job says so."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.paths: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table once and read it back, in place of one of that name."""
        path = scratch_path(self.spark, f"{self.name}-{name}")
        _write(df, path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads."""
        for name in names:
            path = self.paths.pop(name, None)
            if path is not None:
                delete(self.spark, path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when a count proves the table small; otherwise leave the join to Spark."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def delete(spark: SparkSession, pattern: str, chosen: Callable[[str], bool] = lambda name: True) -> None:
    """Remove the files or folders of a glob, in whatever store it is, whose last name is ``chosen``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in store.globStatus(path) or ():
        if chosen(found.getPath().getName()):
            store.delete(found.getPath(), True)
