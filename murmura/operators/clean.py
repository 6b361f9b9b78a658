"""Raw posts to the clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.functions import fields, text
from murmura.operators.dedupe import dedupe_by_content, dedupe_by_id
from murmura.schemas import CLEAN_COLUMNS, COUNTS


def _items(raw: DataFrame, name: str):
    if isinstance(raw.schema[name].dataType, T.ArrayType):
        return F.filter(F.coalesce(name, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    return text.text_items(F.col(name))


def _clean_fields(raw: DataFrame) -> DataFrame:
    """All columns; the text is folded once, for the hash and to be kept."""
    return raw.select(
        F.col("tweet_id").cast("string").alias("tweet_id"),
        text.strip_prefix(text.normalize_text(F.col("username")), "@").alias("username"),
        fields.parse_timestamp(F.col("timestamp")).alias("timestamp"),
        text.normalize_text(F.col("content")).alias("content"),
        *[fields.int_or_zero(F.col(c)).alias(c) for c in COUNTS],
        text.clean_array(_items(raw, "mentions"), "@").alias("mentions"),
        text.clean_array(_items(raw, "hashtags"), "#", folded=True).alias("hashtags"),
        text.fold(text.normalize_text(F.col("query_tag"))).alias("query_tag"),
        "permalink",
        "scraped_at",
    ).select(
        "*", text.fold(F.col("content")).alias("content_norm")
    ).select(
        "*",
        F.sha1("content_norm").alias("content_hash"),
        (F.col("replies") + F.col("retweets") + F.col("likes")).alias("engagement"),
    )


def with_folded_text(posts: DataFrame) -> DataFrame:
    return posts.withColumn("content_norm", text.fold(F.col("content"))).select(*CLEAN_COLUMNS)


def count_bad_numbers(raw: DataFrame, observation: Observation) -> DataFrame:
    """Count, while the rows pass, the numbers that cleaning will read as 0."""
    return raw.observe(
        observation, *[F.count_if(fields.is_bad_number(F.col(c))).alias(f"bad_{c}") for c in COUNTS]
    )


def clean_rows(raw: DataFrame) -> DataFrame:
    """Normalised text, typed numbers and times, cleaned lists, content hash and engagement."""
    return _clean_fields(raw).select(*CLEAN_COLUMNS)


def drop_invalid(posts: DataFrame) -> DataFrame:
    """Only posts with a readable time and an id."""
    return posts.filter(F.col("timestamp").isNotNull() & (F.col("tweet_id") != ""))


def _drop_unreadable(raw: DataFrame) -> DataFrame:
    """`drop_invalid` on the raw columns, before any text is touched."""
    return raw.filter(
        fields.parse_timestamp(F.col("timestamp")).isNotNull() & (F.col("tweet_id").cast("string") != "")
    )


def clean_and_dedupe(raw: DataFrame) -> DataFrame:
    """Clean, drop invalid rows, keep the latest per id and then the latest per text.

    The posts are stored by this call, without the folded text, which is as wide as the text itself and
    is derived again from the survivors.
    """
    cleaned = _clean_fields(_drop_unreadable(raw)).drop("content_norm")
    return with_folded_text(dedupe_by_content(dedupe_by_id(cleaned)))
