"""Summary, topic means, histogram and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.defaults import HISTOGRAM_BINS, PLOT_SAMPLE, SEED


def summary(scored: DataFrame) -> DataFrame:
    """One row: posts, mean signal, shares above and below zero, sorted distinct topics."""
    return scored.agg(
        F.count("*").alias("tweets"),
        F.avg("tweet_signal").alias("mean_signal"),
        F.avg((F.col("tweet_signal") > 0).cast("double")).alias("bullish_share"),
        F.avg((F.col("tweet_signal") < 0).cast("double")).alias("bearish_share"),
        F.array_sort(F.collect_set("query_tag")).alias("hashtags"),
    )


def tag_means(scored: DataFrame) -> DataFrame:
    """Mean signal of each topic, lowest first."""
    return scored.groupBy("query_tag").agg(F.avg("tweet_signal").alias("mean_signal")).orderBy(
        "mean_signal", "query_tag"
    )


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum, empty bins included.

    The last bin is closed. When all values are equal the range is widened by half on each side.
    """
    value = F.col(column).cast("double")
    low, high = F.min(value), F.max(value)
    edges = df.agg(
        F.struct(
            F.when(low == high, low - 0.5).otherwise(low).alias("low"),
            F.when(low == high, high + 0.5).otherwise(high).alias("high"),
        ).alias("edges")
    ).scalar()
    at = F.floor((value - F.col("_edges.low")) * bins / (F.col("_edges.high") - F.col("_edges.low")))
    counted = (
        df.filter(value.isNotNull())
        .withColumn("_edges", edges)
        .select(F.least(at, F.lit(bins - 1).cast("bigint")).alias("bin"))
        .groupBy("bin")
        .count()
    )
    width = (F.col("_edges.high") - F.col("_edges.low")) / bins
    return (
        df.sparkSession.range(bins)
        .select(F.col("id").alias("bin"), edges.alias("_edges"))
        .filter(F.col("_edges.low").isNotNull())
        .join(counted, "bin", "left")
        .select(
            "bin",
            (F.col("_edges.low") + F.col("bin") * width).alias("bin_low"),
            (F.col("_edges.low") + (F.col("bin") + 1) * width).alias("bin_high"),
            F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
        )
    )


def sample_rows(df: DataFrame, n: int = PLOT_SAMPLE, seed: int = SEED, key: str = "tweet_id") -> DataFrame:
    """Exactly n rows without replacement, the same on every run; all rows when there are fewer."""
    return df.orderBy(F.md5(F.concat_ws(":", key, F.lit(str(seed)))), key).limit(n)
