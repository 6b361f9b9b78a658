"""Captured elements to stored raw posts, in runs that resume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.defaults import TARGET_POSTS
from murmura.operators.dedupe import new_posts
from murmura.operators.extract import extract_posts
from murmura.operators.lookback import take_target
from murmura.sources.raw import append_raw, read_raw


def ingest_posts(capture: DataFrame, folder: str, target: int = TARGET_POSTS, resume: bool = True) -> DataFrame:
    """Append the new posts of a capture to the existing raw folder; returns all posts stored there.

    A run that resumes skips the ids stored before, and they count towards the target; malformed
    stored lines are passed over. A fresh run counts only its own posts.
    """
    arriving, room = extract_posts(capture), target
    if resume:
        # The listing of files is taken before the append, so the new rows don't read themselves.
        stored = read_raw(capture.sparkSession, folder, on_bad="drop").select("tweet_id")
        room = max(0, target - stored.select(F.count_distinct("tweet_id")).first()[0])
        arriving = new_posts(arriving, stored)
    append_raw(take_target(arriving.filter(F.col("tweet_id") != ""), room), folder)
    return read_raw(capture.sparkSession, folder, on_bad="drop")
