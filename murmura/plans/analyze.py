"""Stored clean table to signals, aggregates and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from murmura.defaults import BEARISH, BUCKET, BULLISH
from murmura.operators.buckets import aggregate_signals, ci_series
from murmura.operators.report import histogram, summary, tag_means
from murmura.operators.scoring import max_strength, score_posts, with_features, with_signal
from murmura.operators.tfidf import fit_tfidf
from murmura.sources.tables import write_agg, write_scored, write_summary, write_vocabulary
from murmura.storage import materialize

# What the aggregates read of a post.
SIGNAL_COLUMNS = ["tweet_id", "timestamp", "query_tag", "engagement", "likes"]


@dataclass(frozen=True)
class Analysis:
    """The results of one run, each a lazy table."""

    scored: DataFrame
    aggregated: DataFrame
    vocabulary: DataFrame
    summary: DataFrame
    tag_means: DataFrame
    engagement_histogram: DataFrame
    series: DataFrame


def hourly_signals(
    posts: DataFrame,
    bullish: list[str] = BULLISH,
    bearish: list[str] = BEARISH,
    bucket: str = BUCKET,
    **limits,
) -> DataFrame:
    """Only the aggregated table. Texts are read for scoring and never stored again."""
    scored = score_posts(posts, bullish, bearish, columns=SIGNAL_COLUMNS, **limits)
    return aggregate_signals(scored, bucket=bucket)


def analyze_posts(
    posts: DataFrame,
    bullish: list[str] = BULLISH,
    bearish: list[str] = BEARISH,
    bucket: str = BUCKET,
    **limits,
) -> Analysis:
    """All results. ``posts`` is read several times: pass a stored table."""
    tfidf = fit_tfidf(posts, **limits)
    features = materialize(with_features(posts, tfidf, bullish, bearish), "features")
    scored = with_signal(features, max_strength(features))
    aggregated = aggregate_signals(scored, bucket=bucket)
    return Analysis(
        scored=scored,
        aggregated=aggregated,
        vocabulary=tfidf.vocabulary(posts.sparkSession).drop("term_index"),
        summary=summary(scored),
        tag_means=tag_means(scored),
        engagement_histogram=histogram(scored, "engagement"),
        series=ci_series(aggregated),
    )


def write_analysis(analysis: Analysis, folder: str) -> None:
    write_scored(analysis.scored, f"{folder}/scored")
    write_agg(materialize(analysis.aggregated, "aggregated"), f"{folder}/aggregated", f"{folder}/sample_aggregated")
    write_vocabulary(analysis.vocabulary, f"{folder}/vocabulary")
    write_summary(analysis.summary, f"{folder}/summary")
    for name in ("tag_means", "engagement_histogram", "series"):  # what the charts are drawn from
        getattr(analysis, name).write.mode("overwrite").parquet(f"{folder}/{name}")
