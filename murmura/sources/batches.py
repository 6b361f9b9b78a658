"""Tables that a stream adds to, each micro-batch once, and that are gathered into few files later."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.storage import broadcast_if_small, delete, releasing

VERSIONS = "seq bigint, version string, part string, run string, upto bigint"


class BatchTable:
    """A Parquet table of batches.

    ``open`` holds the batches, in folders that end in ``run=/batch=``: a batch that is handed over again, as
    after a crash, replaces its own folders and adds nothing. `gather` rewrites what is there in few files, as
    a version of its own, and then records which batches the version has in it; from that record on, readers
    take the version and pass over those batches. Batches that arrive later, or again, change nothing of that.

    ``folders`` are the columns a table is partitioned by. With ``part``, the first of them, each of its
    values is gathered by itself, such as a date that is closed. A ``run`` names one checkpoint, whose
    batch numbers grow; see `murmura.streaming.sinks.checkpoint_id`. Columns that are ``derived`` from others are stored, but
    made anew where files are written, so that they aren't shuffled.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, folders: tuple[str, ...] = (), part: str | None = None, derived: dict[str, Column] | None = None):
        if part is not None and folders[:1] != (part,):
            raise ValueError("what is gathered by itself must be the first folder")
        self.spark, self.path, self.folders, self.part, self.derived = spark, path.rstrip("/"), folders, part, derived or {}
        self.schema = spark.createDataFrame([], schema).schema
        self._open = T.StructType([*self.schema, T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())])
        self._gathered = T.StructType([*self.schema, T.StructField("version", T.StringType())])
        # Folders that aren't there yet are made, so that an empty table can be read.
        for name, own, by in (("open", self._open, [*folders, "run", "batch"]), ("gathered", self._gathered, ["version", *folders])):
            spark.createDataFrame([], own).write.mode("ignore").partitionBy(*by).parquet(f"{self.path}/{name}")
        spark.createDataFrame([], VERSIONS).write.mode("ignore").parquet(f"{self.path}/versions")

    def _part(self) -> Column:
        return F.col(self.part).cast("string") if self.part else F.lit("")

    def _balanced(self, rows: DataFrame) -> DataFrame:
        """The rows of a folder in one task, unless they are too many for one; derived columns are made there."""
        return rows.drop(*self.derived).hint("rebalance", *self.folders).withColumns(self.derived).select(*rows.columns)

    def put(self, rows: DataFrame, run: str, batch: int) -> None:
        """Store a batch, or replace it. Files follow the folders: one in each, unless it is large."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", run):
            raise ValueError(f"{run!r} cannot name a run")
        own = self._balanced(rows.select(*self.schema.names)).withColumns(
            {"run": F.lit(run), "batch": F.lit(batch).cast("bigint")}
        )
        with releasing(own):
            own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(
                *self.folders, "run", "batch"
            ).parquet(f"{self.path}/open")

    def _read_open(self) -> DataFrame:
        return self.spark.read.schema(self._open).parquet(f"{self.path}/open")

    def _current(self) -> DataFrame:
        """The latest version of each part, with the last batch of each run that it has in it."""
        rows = self.spark.read.schema(VERSIONS).parquet(f"{self.path}/versions")
        latest = rows.groupBy("part").agg(F.max("seq").alias("seq"))
        return rows.join(broadcast_if_small(latest), ["part", "seq"])

    def waiting(self, without: tuple[str, int] | None = None) -> DataFrame:
        """The rows of batches that aren't gathered yet; ``without`` leaves out one batch."""
        rows = self._read_open()
        if without is not None:
            rows = rows.where(~((F.col("run") == without[0]) & (F.col("batch") == without[1])))
        known = self._current().select(F.col("part").alias("_part"), F.col("run").alias("_run"), "upto")
        there = (self._part() == F.col("_part")) & (F.col("run") == F.col("_run")) & (F.col("batch") <= F.col("upto"))
        return rows.join(broadcast_if_small(known), there, "left_anti").select(*self.schema.names)

    def read(self, without: tuple[str, int] | None = None) -> DataFrame:
        """All rows, each batch once; ``without`` leaves out one batch that isn't gathered yet."""
        versions = self._current().select(F.col("part").alias("_part"), F.col("version").alias("_version")).distinct()
        there = (self._part() == F.col("_part")) & (F.col("version") == F.col("_version"))
        gathered = self.spark.read.schema(self._gathered).parquet(f"{self.path}/gathered")
        gathered = gathered.join(broadcast_if_small(versions), there, "left_semi")
        return gathered.select(*self.schema.names).unionByName(self.waiting(without))

    def gather(
        self,
        where: Column | None = None,
        reduce: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        below: tuple[str, int] | None = None,
    ) -> None:
        """Rewrite the parts that ``where`` chooses in few files, after ``reduce`` has seen all their rows.

        ``below`` names the run and number of the batch that is being handled: it may yet be handed over
        again, and is not gathered.
        """
        rows = self._read_open().groupBy("run").agg(F.max("batch").alias("upto")).collect()
        upto = {r.run: min(r.upto, below[1] - 1) if below and below[0] == r.run else r.upto for r in rows}
        upto = {run: n for run, n in upto.items() if n >= 0}
        if not upto:
            return
        version, whole = uuid.uuid4().hex, self.read(without=below)
        chosen = whole if where is None else whole.where(where)
        made = self._balanced(reduce(chosen).select(*self.schema.names)).withColumn("version", F.lit(version))
        with releasing(made):
            made.write.mode("append").option("compression", "zstd").partitionBy("version", *self.folders).parquet(f"{self.path}/gathered")
        back = self.spark.read.schema(self._gathered).parquet(f"{self.path}/gathered").where(F.col("version") == version)
        parts = back.select(self._part().alias("part")).distinct()
        seq = self.spark.read.schema(VERSIONS).parquet(f"{self.path}/versions").agg(F.max("seq")).first()[0]
        runs = F.array(*[F.struct(F.lit(run).alias("run"), F.lit(n).cast("bigint").alias("upto")) for run, n in upto.items()])
        record = parts.select("part", F.explode(runs).alias("r")).select(
            F.lit((seq or 0) + 1).cast("bigint").alias("seq"), F.lit(version).alias("version"), "part", "r.run", "r.upto"
        )
        # One file, which counts from the moment it is there.
        record.coalesce(1).write.mode("append").parquet(f"{self.path}/versions")

    def clean(self) -> None:
        """Remove the files that no reader takes any more: gathered batches, and versions with a later one."""
        rows = self.spark.read.schema(VERSIONS).parquet(f"{self.path}/versions")
        latest = rows.groupBy("part").agg(F.max("seq").alias("last"))
        for r in rows.join(broadcast_if_small(latest), "part").collect():
            folder = f"{self.part}={r.part}/" if self.part else ""
            if r.seq < r.last:
                delete(self.spark, f"{self.path}/gathered/version={r.version}/{folder}".rstrip("/"))
            else:
                deeper = "*/" * (len(self.folders) - bool(self.part))
                delete(self.spark, f"{self.path}/open/{folder}{deeper}run={r.run}/batch=*", lambda name, n=r.upto: int(name.partition("=")[2]) <= n)
