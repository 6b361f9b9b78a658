"""Posts, raw and captured, made from the given tables.

The raw rows carry the faults that cleaning has to deal with: repeated ids, repeated texts,
control characters, mixed time formats, unreadable times and numbers, bare strings for lists.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.operators.clean import clean_and_dedupe, clean_rows
from murmura.session import use_utc
from murmura.storage import materialize

AS_OF = "2024-01-31 00:00:00"

# Words that occur in the given texts, so that signals are not all zero.
BULLISH = ["the", "la", "der"]
BEARISH = ["and", "of", "el"]

TOPICS = ["click", "purchase", "en", "fr"]

# Posts for a task: sizes are judged by the narrow rows that are shuffled, before texts are joined to them.
TASK_POSTS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per event, with the whole text of a document.

    The tables are single files, so the join shuffles them to give the later steps several tasks.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    events = table(spark, sf_dir, "events")
    count = documents.agg(F.count("*")).scalar()
    tasks = math.ceil(events.count() / TASK_POSTS)
    value = F.floor("value")
    numbered = events.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("ts"),
        value.alias("value"),
        ((F.col("event_id") * 7) % count).alias("doc_id"),
    )
    if tasks > spark.sparkContext.defaultParallelism:
        numbered = numbered.repartition(tasks, "doc_id")
    return (
        numbered.join(documents.hint("merge"), "doc_id")
        .withColumn(
            "tags",
            F.when(
                F.col("event_type").isin("click", "purchase"),
                F.concat(F.lit(" #"), F.initcap("event_type"), F.lit(" #"), "lang", F.lit(" @user_"), F.col("user_id").cast("string")),
            ).otherwise(F.lit("")),
        )
    )


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _post_number() -> Column:
    return F.col("event_id") - F.when(F.col("event_id") % 10 == 9, 1).otherwise(0)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = _text("user_id")
    value = F.col("value")
    shifted = F.date_format(F.col("ts") + F.expr("INTERVAL '05:30' HOUR TO MINUTE"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return _posts(spark, sf_dir).select(
        F.when(value == 14, F.lit(""))
        .when(value == 15, F.lit(None).cast("string"))
        .otherwise(_text(_post_number()))
        .alias("tweet_id"),
        F.concat(F.lit("@@ＵＳＥＲ_"), user).alias("username"),
        F.when(value == 13, F.lit("not a time"))
        .when(F.col("user_id") % 2 == 1, F.concat(shifted, F.lit("+05:30")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("timestamp"),
        F.concat(F.lit("\x0b  "), "text", "tags", F.lit("\t ")).alias("content"),
        F.when(value == 16, F.lit("n/a")).otherwise(_text(F.col("event_id") % 7)).alias("replies"),
        F.concat(_text(F.col("event_id") % 11), F.lit(".7")).alias("retweets"),
        _text("value").alias("likes"),
        F.when(F.col("user_id") % 3 != 0, _text(value * 10)).alias("views"),
        F.when(F.col("user_id") % 5 == 0, F.concat(F.lit("@user_"), user))
        .when(F.col("user_id") % 5 != 1, F.concat(F.lit('["@@user_'), user, F.lit('","","@ﬁrm"]')))
        .alias("mentions"),
        F.concat(F.lit('["#'), F.initcap("event_type"), F.lit('","","#STRAßE"]')).alias("hashtags"),
        F.when(F.col("event_type") == "error", F.lit(""))
        .otherwise(F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")))
        .alias("query_tag"),
        F.concat(F.lit("https://example.org/user_"), user, F.lit("/status/"), _text("event_id")).alias("permalink"),
        F.lpad(_text("event_id"), 12, "0").alias("scraped_at"),
    )


def capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = _text("user_id")
    value = _text("value")
    link = F.concat(F.lit("https://example.org/user_"), user, F.lit("/status/"), _text(_post_number()))
    return _posts(spark, sf_dir).select(
        F.when(F.col("value") == 20, F.lit(None).cast("string"))
        .when(F.col("event_type") == "signup", F.concat(link, F.lit("//")))
        .when(F.col("event_type") == "error", F.lit("https://example.org/about"))
        .otherwise(link)
        .alias("permalink"),
        F.when(F.col("value") != 21, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("datetime"),
        F.when(F.col("user_id") % 4 == 0, F.concat(F.lit("Name\n@user_"), user, F.lit("\n1h")))
        .when(F.col("user_id") % 4 == 1, F.concat(F.lit("@@user_"), user))
        .when(F.col("user_id") % 4 == 2, F.concat(F.lit("Name "), user, F.lit("\n2h")))
        .alias("user_block"),
        F.concat("text", "tags").alias("content"),
        F.concat(value, F.lit(",001 replies")).alias("reply_label"),
        F.concat(value, F.lit(".25K")).alias("retweet_label"),
        F.when(F.col("value") % 3 == 0, F.lit("Likes"))
        .when(F.col("value") % 3 == 1, F.concat(value, F.lit(" minutes")))
        .otherwise(F.concat(value, F.lit(".2.3")))
        .alias("like_label"),
        F.when(F.col("value") % 2 == 0, F.concat(value, F.lit("m views"))).otherwise(F.lit("")).alias("views_label"),
        F.lit("mixed").alias("query_tag"),
        F.lpad(_text("event_id"), 12, "0").alias("scraped_at"),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_rows(raw(spark, sf_dir))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table without duplicates, lazily."""
    return clean_and_dedupe(raw(spark, sf_dir))


def stored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table, written once for jobs that read it several times."""
    return materialize(posts(spark, sf_dir), "clean")
