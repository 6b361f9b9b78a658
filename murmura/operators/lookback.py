"""Time windows, ordering and row targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.defaults import LOOKBACK_HOURS, TARGET_POSTS
from murmura.functions.fields import parse_timestamp
from murmura.operators.dedupe import keep_first, total_order
from murmura.storage import BROADCAST_ROWS

HOUR_MICROS = 3_600_000_000


def instant(as_of) -> Column:
    """A timestamp column from a column, datetime, date or text; without an offset they are UTC."""
    if isinstance(as_of, Column):
        return as_of
    return parse_timestamp(F.lit(as_of if isinstance(as_of, str) else as_of.isoformat()))


def window_start(as_of, hours: int) -> Column:
    """So many hours before; counted in microseconds, as a day of a session's zone may have 23 or 25."""
    return F.timestamp_micros(F.unix_micros(instant(as_of)) - hours * HOUR_MICROS)


def fixed_lookback(posts: DataFrame, as_of, hours: int) -> DataFrame:
    return posts.filter(F.col("timestamp") >= window_start(as_of, hours))


def widening_lookback(
    posts: DataFrame,
    as_of,
    hours: Sequence[int] = LOOKBACK_HOURS,
    target: int = TARGET_POSTS,
) -> DataFrame:
    """The first window, in the order given, with at least ``target`` posts; all posts if none has.

    One scan of the widest window counts all candidates; the chosen start reaches the second
    scan as a scalar subquery, so both can prune files by time. ``posts`` is read twice: pass a
    stored table.
    """
    counts = fixed_lookback(posts, as_of, max(hours)).agg(
        *[F.count_if(F.col("timestamp") >= window_start(as_of, h)).alias(f"within_{h}") for h in hours]
    )
    chosen = F.coalesce(
        *[F.when(F.col(f"within_{h}") >= target, window_start(as_of, h)) for h in hours],
        instant("0001-01-01 00:00:00"),
    )
    return posts.filter(F.col("timestamp") >= counts.select(chosen.alias("start")).scalar())


def reaching_window(posts: DataFrame, as_of, hours: Sequence[int], target: int) -> int | None:
    """The first window, in the order given, with at least ``target`` posts; None if none has."""
    within = [F.count_if(F.col("timestamp") >= window_start(as_of, h)) for h in hours]
    counts = posts.agg(*within).first()
    return next((h for h, n in zip(hours, counts) if n >= target), None)


def take_target(posts: DataFrame, n: int = TARGET_POSTS) -> DataFrame:
    """The first n distinct posts in the order they were collected.

    Which they are is found from ids and times alone; whole posts are read again, only of those n ids.
    """
    seen = posts.groupBy("tweet_id").agg(F.min("scraped_at").alias("scraped_at"))
    chosen = seen.orderBy("scraped_at", "tweet_id").limit(n).select(F.col("tweet_id").alias("_id"), F.col("scraped_at").alias("_at"))
    same = F.col("tweet_id").eqNullSafe(F.col("_id")) & F.col("scraped_at").eqNullSafe(F.col("_at"))
    first = posts.join(F.broadcast(chosen) if n <= BROADCAST_ROWS else chosen, same, "left_semi")
    return keep_first(first, "tweet_id", total_order(posts, ["scraped_at"])).orderBy("scraped_at", "tweet_id").limit(n)


def latest(posts: DataFrame, n: int) -> DataFrame:
    """The n newest posts."""
    return posts.orderBy(F.col("timestamp").desc(), "tweet_id").limit(n)
