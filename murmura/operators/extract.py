"""Captured page elements to raw posts, and topic selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.defaults import MIXED_TOPIC
from murmura.functions import fields
from murmura.operators.lookback import window_start


def extract_posts(capture: DataFrame, strict_suffix: bool = False) -> DataFrame:
    """One raw post per captured element that has a time and a status link."""
    content = F.coalesce("content", F.lit(""))
    return capture.filter(F.col("datetime").isNotNull() & fields.is_post_link(F.col("permalink"))).select(
        fields.post_id(F.col("permalink")).alias("tweet_id"),
        fields.username(F.col("user_block")).alias("username"),
        F.col("datetime").alias("timestamp"),
        content.alias("content"),
        *[
            fields.parse_count(F.col(label), strict_suffix).alias(name)
            for label, name in [
                ("reply_label", "replies"),
                ("retweet_label", "retweets"),
                ("like_label", "likes"),
                ("views_label", "views"),
            ]
        ],
        fields.mentions(content).alias("mentions"),
        fields.hashtags(content).alias("hashtags"),
        "query_tag",
        "permalink",
        "scraped_at",
    )


def _topics(tags: list[str]) -> Column:
    return F.array(*[F.lit(t) for t in tags])


def topic_filter(posts: DataFrame, tags: list[str], as_of, lookback_hours: int = 24) -> DataFrame:
    """Posts that carry any of the tags, from the day on which the lookback starts."""
    since = fields.utc_day(window_start(as_of, lookback_hours))
    return posts.filter((F.col("timestamp") >= since) & F.arrays_overlap("hashtags", _topics(tags)))


def assign_topic(posts: DataFrame, tags: list[str], mixed: str = MIXED_TOPIC) -> DataFrame:
    """Label by the one configured tag in the post, ``mixed`` for several, empty for none."""
    found = F.array_intersect("hashtags", _topics(tags))
    topic = (
        F.when(F.size(found) == 1, F.element_at(found, 1))
        .when(F.size(found) > 1, F.lit(mixed))
        .otherwise(F.lit(""))
    )
    return posts.withColumn("query_tag", topic)
