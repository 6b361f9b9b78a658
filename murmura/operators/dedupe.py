"""Duplicate removal.

Every rank filter below keeps one row per key, which Spark turns into a limit per key on the map
side: however many copies a hot key has, each map task ships at most one of them.

Posts are stored before they are ranked, so no text is sorted or shuffled: only the columns that decide
are, and the places of the survivors come back as bitmaps that filter the stored table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.storage import BROADCAST_ROWS, broadcast_if_small, delete, materialize

# Copies of an id that agree in time are told apart by the remaining columns, so that a retried
# task picks the same survivor.
ID_ORDER = ["timestamp", "scraped_at", "content_hash", "query_tag", "engagement", "views", "likes"]
CONTENT_ORDER = ["timestamp", "tweet_id"]

# Wide columns, which are left out of the shuffles; in orders a digest stands for them.
TEXTS = ["content", "content_norm"]

# Bitmaps of 4 KB, one for 32,768 rows of a file, up to which they are broadcast.
BROADCAST_BITMAPS = 25_000
BITMAP_ROWS = 32_768


def _one_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_last(df: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    return _one_per_key(df, key, [_column(c).desc_nulls_last() for c in order])


def keep_first(df: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    return _one_per_key(df, key, [_column(c).asc_nulls_last() for c in order])


def total_order(df: DataFrame, first: list[str]) -> list[str | Column]:
    """``first`` and then all other columns, so that only fully equal rows can tie."""
    rest = [F.to_json(F.struct(F.col(c))) if "<" in kind else F.col(c) for c, kind in df.dtypes if c not in first]
    return [*first, *rest]


@dataclass(frozen=True)
class _Kept:
    """A stored table and those of its rows that are kept: their columns but the texts, ``_file`` and ``_row``."""

    stored: DataFrame
    columns: list[str]
    rows: DataFrame


def _stored(posts: DataFrame) -> _Kept:
    texts = [c for c in TEXTS if c in posts.columns]
    stored = materialize(posts.withColumns({f"_{c}": F.xxhash64(c) for c in texts}), "posts")
    return _Kept(stored, posts.columns, with_places(stored).drop(*texts))


def with_places(stored: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_row``, where a row of a stored table lies."""
    return stored.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def rows_at(stored: DataFrame, places: DataFrame) -> DataFrame:
    """The whole rows of a stored table at some ``_file`` and ``_row``."""
    place = F.col("_row") + 1  # bitmaps count from one
    bitmaps = places.groupBy("_file", F.bitmap_bucket_number(place).alias("_bitmap")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )
    if stored.count() / BITMAP_ROWS + len(stored.inputFiles()) <= BROADCAST_BITMAPS:
        bitmaps = F.broadcast(bitmaps)
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = with_places(stored).withColumn("_bitmap", F.bitmap_bucket_number(place)).join(bitmaps, ["_file", "_bitmap"])
    return found.where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*stored.columns)


def _rows_kept(kept: _Kept) -> DataFrame:
    """The whole rows, taken out of the stored table by their places."""
    return rows_at(kept.stored, kept.rows).select(*kept.columns)


def _keep_posts(posts: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last post of each key. Posts that come out of such a step are not stored again by the next."""
    kept = getattr(posts, "_kept", None) or _stored(posts)
    kept = _Kept(kept.stored, kept.columns, keep_last(kept.rows, key, order))
    found = _rows_kept(kept)
    found._kept = kept
    return found


def release(posts: DataFrame) -> None:
    """Remove the table that a step here has stored for these posts, when they are stored elsewhere."""
    kept = getattr(posts, "_kept", None)
    files = kept.stored.inputFiles() if kept else ()
    if files:
        delete(posts.sparkSession, files[0].rpartition("/")[0])


def dedupe_by_id(posts: DataFrame) -> DataFrame:
    """The latest version of each id. The posts are stored by this call."""
    names = [f"_{c}" if c in TEXTS else c for c in posts.columns]
    kinds = dict(posts.dtypes)
    first = [c for c in ID_ORDER if c in posts.columns]
    rest = [F.to_json(F.struct(c)) if "<" in kinds.get(c, "") else c for c in names if c not in first]
    return _keep_posts(posts, "tweet_id", [*first, *rest])


def dedupe_by_content(posts: DataFrame) -> DataFrame:
    """The latest post of each text. The posts are stored by this call, unless `dedupe_by_id` has stored them."""
    return _keep_posts(posts, "content_hash", CONTENT_ORDER)


def new_posts(incoming: DataFrame, existing: DataFrame, order: str = "scraped_at") -> DataFrame:
    """Incoming posts with ids not stored yet, the first seen of each.

    When a count proves the batch small, its ids are broadcast and the history is only filtered by them;
    the known ones among them, never more, are broadcast too. Otherwise both sides are reduced to one row
    per id before they meet, on the same partitioning. The incoming posts are stored by this call, and ranked by ids and
    ``order``; whole posts are compared only of ids whose first ones agree in that.
    """
    stored = materialize(incoming.filter(F.col("tweet_id") != ""), "incoming")
    small = stored.select("tweet_id").limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    known = existing.select("tweet_id")
    if small:
        known = known.join(F.broadcast(stored.select("tweet_id")), "tweet_id", "left_semi")
    known = known.distinct()
    first = F.rank().over(Window.partitionBy("tweet_id").orderBy(F.col(order).asc_nulls_last()))
    seen_first = with_places(stored.select("tweet_id", order)).withColumn("_rank", first).filter(F.col("_rank") == 1)
    fresh = seen_first.join(F.broadcast(known) if small else known, "tweet_id", "left_anti")
    fresh = materialize(fresh.select("tweet_id", "_file", "_row"), "fresh")
    tied = fresh.groupBy("tweet_id").count().filter("count > 1").select("tweet_id")
    if tied.isEmpty():
        return rows_at(stored, fresh)
    tied = broadcast_if_small(tied)
    several = rows_at(stored, fresh.join(tied, "tweet_id", "left_semi"))
    one = rows_at(stored, fresh.join(tied, "tweet_id", "left_anti"))
    return one.unionByName(keep_first(several, "tweet_id", total_order(incoming, [order])))
