"""What becomes of each micro-batch: every sink here stores a batch once, however often it is handed over.

A micro-batch is handed over again when a run ends between storing it and noting that in the checkpoint.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from murmura.defaults import TARGET_POSTS
from murmura.functions.text import folded
from murmura.operators.dedupe import dedupe_by_content, dedupe_by_id, new_posts, release
from murmura.operators.extract import extract_posts
from murmura.operators.lookback import take_target
from murmura.schemas import CAPTURE
from murmura.sources.batches import BatchTable
from murmura.sources.raw import read_raw
from murmura.sources.tables import with_partitions
from murmura.storage import materialize

#: Batches after which a table is gathered into few files.
GATHER_EVERY = 50


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that a checkpoint belongs to. It outlives restarts, and another checkpoint has another."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def each_batch(rows: DataFrame, checkpoint: str, handle: Callable[[DataFrame, str, int], None]) -> DataStreamWriter:
    """A stream that hands over each micro-batch with the name of its run and its number."""
    names: list[str] = []

    def run(batch: DataFrame, number: int) -> None:
        if not names:
            names.append(checkpoint_id(batch.sparkSession, checkpoint))
        handle(batch, names[0], number)

    return rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


# --- keep-last: a stored table of the latest version of each id


class LatestPosts:
    """The latest version of each id among all posts that ever arrived (keep-last by id, then by text).

    Batches are added as they come, reduced to one row an id, and the latest is found when the table is
    read or gathered: the same whatever the order and the cut of the batches. Texts are compared only then,
    since a later version of one post may set free the text of another. The folded text of clean posts, as wide as
    the text, is not stored but derived when they are read; what is stored on the way goes with each batch.
    """

    def __init__(self, spark: SparkSession, path: str, schema, gather_every: int = GATHER_EVERY):
        empty = spark.createDataFrame([], schema)
        self.columns, self.derived = empty.columns, folded(empty.columns)
        self.table, self.gather_every = BatchTable(spark, path, empty.drop(*self.derived).schema), gather_every

    def __call__(self, posts: DataFrame, run: str, batch: int) -> None:
        made: list[DataFrame] = []

        def latest(rows: DataFrame) -> DataFrame:
            made.append(dedupe_by_id(rows))
            return made[-1]

        if batch and batch % self.gather_every == 0:
            self.table.gather(reduce=latest, below=(run, batch))
        self.table.put(latest(posts.drop(*self.derived)), run, batch)
        for rows in made:
            release(rows)

    def _whole(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns(self.derived).select(*self.columns)

    def by_id(self) -> DataFrame:
        return self._whole(dedupe_by_id(self.table.read()))

    def posts(self) -> DataFrame:
        """Also only the latest post of each text, as `clean_and_dedupe` keeps."""
        return self._whole(dedupe_by_content(dedupe_by_id(self.table.read())))


# --- keep-first: arriving elements to stored raw posts, up to a target


class TargetReached(Exception):
    """There is no room for another post; the batch stays unread for a later run."""


class Ingest:
    """Append the new posts of captured elements to a raw folder until it has ``target`` of them.

    An id that is stored already, by this run, by one with another checkpoint or by a batch job, is
    passed over; of the copies in a batch the first collected stays. Ids are held in a table of their own
    beside the raw folder, so a batch reads no text of the history. When a run starts, ids that others have
    stored in the folder since are taken over into that table.
    """

    def __init__(self, spark: SparkSession, folder: str, ids: str, target: int = TARGET_POSTS, gather_every: int = GATHER_EVERY):
        self.spark, self.folder, self.target, self.gather_every = spark, folder.rstrip("/"), target, gather_every
        self.ids, self.reached, self._seeded = BatchTable(spark, ids, "tweet_id string"), False, False

    def _seed(self) -> None:
        """Take over ids of the folder that the table doesn't know, under a name that nothing else replaces."""
        stored = read_raw(self.spark, self.folder, on_bad="drop").select("tweet_id").distinct()
        unknown = stored.join(self.ids.read(), "tweet_id", "left_anti")
        self.ids.put(unknown, f"seed-{uuid.uuid4().hex}", 0)

    def _folder_exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _take_over(self) -> None:
        if not self._seeded and self._folder_exists():
            self._seed()
        self._seeded = True

    def full(self) -> bool:
        """Whether the folder has its target already, so that nothing need be read."""
        self._take_over()
        self.reached = self.reached or self.ids.read().count() >= self.target
        return self.reached

    def __call__(self, captured: DataFrame, run: str, batch: int) -> None:
        self._take_over()
        if batch and batch % self.gather_every == 0:
            self.ids.gather(below=(run, batch))
        known = self.ids.read(without=(run, batch))
        room = self.target - known.count()
        if room <= 0:
            self.reached = True
            raise TargetReached(f"{self.folder} has {self.target} posts")
        arriving = extract_posts(captured).where(F.col("tweet_id") != "")
        fresh = materialize(take_target(new_posts(arriving, known), room), "arrived")
        # Ids first: should the run end here, the batch comes again and finds none of its own among the known.
        self.ids.put(fresh, run, batch)
        fresh.write.mode("overwrite").json(f"{self.folder}/{run}-{batch:012d}")


def stream_capture(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Captured elements as they arrive in a folder of JSON lines."""
    reader = spark.readStream.schema(CAPTURE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def ingest_stream(captured: DataFrame, folder: str, ids: str, checkpoint: str, target: int = TARGET_POSTS) -> Ingest:
    """Store what has arrived, batch by batch, and stop when the target is reached; what is left stays unread."""
    sink = Ingest(captured.sparkSession, folder, ids, target)
    if sink.full():
        return sink
    query = each_batch(captured, checkpoint, sink).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not sink.reached:
            raise
    return sink


# --- partitioned folders with few files


class PartitionedPosts:
    """Posts in ``date=/hashtag=`` folders, one file in each a batch, and one in all when a date is closed."""

    def __init__(self, spark: SparkSession, path: str, schema):
        folders = ("date", "hashtag")
        own = with_partitions(spark.createDataFrame([], schema)).schema
        self.table = BatchTable(spark, path, own, folders, part="date", derived=folded(own.names))

    def __call__(self, posts: DataFrame, run: str, batch: int) -> None:
        self.table.put(with_partitions(posts), run, batch)

    def close(self, before: str) -> None:
        """Gather the dates before a given one, written like ``2026-01-31``, into one file a folder.

        Dates that got posts since they were closed are gathered again, the others stay as they are.
        """
        waiting = self.table.waiting().where(F.col("date") < before).select("date").distinct()
        dates = [r["date"] for r in waiting.collect()]  # as many as days have open batches
        if dates:
            self.table.gather(F.col("date").isin(dates))

    def posts(self) -> DataFrame:
        return self.table.read()
