"""Signal of each post, and the frozen model that scores later posts the same way."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.defaults import BEARISH, BULLISH
from murmura.functions import signal
from murmura.operators.tfidf import TfidfModel, fit_tfidf, fit_tokens, worded
from murmura.storage import materialize


@dataclass(frozen=True)
class SignalModel:
    """What scoring has to know about the whole corpus."""

    tfidf: TfidfModel
    max_strength: float

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON row; its size is bounded by the vocabulary cap."""
        spark.createDataFrame([(json.dumps(asdict(self), ensure_ascii=False),)], "value string").write.mode(
            "overwrite"
        ).text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> SignalModel:
        stored = json.loads(spark.read.text(path).first()["value"])
        return SignalModel(TfidfModel(**stored["tfidf"]), stored["max_strength"])


def with_features(
    posts: DataFrame,
    tfidf: TfidfModel,
    bullish: list[str] = BULLISH,
    bearish: list[str] = BEARISH,
) -> DataFrame:
    """Add lexicon_score, tfidf_strength and engagement_weight, row by row."""
    lexical = posts.withColumn(
        "lexicon_score", signal.lexicon_score(F.col("content_norm"), bullish, bearish)
    )
    return tfidf.strength(lexical).withColumn(
        "engagement_weight", signal.engagement_weight(F.col("engagement"))
    )


def with_signal(features: DataFrame, max_strength) -> DataFrame:
    """Add tweet_signal. ``max_strength`` is the corpus maximum: a number or a one-value column."""
    top = max_strength if not isinstance(max_strength, (int, float)) else F.lit(float(max_strength))
    return features.withColumn(
        "tweet_signal",
        signal.blend_signal(
            F.col("lexicon_score"), F.col("engagement_weight"), F.col("tfidf_strength"), top
        ),
    )


def max_strength(features: DataFrame):
    """The corpus maximum as a scalar subquery."""
    return features.agg(F.max("tfidf_strength")).scalar()


def fit_signal_model(posts: DataFrame, **limits) -> SignalModel:
    """Fit the vocabulary and the strongest text. ``posts`` is read once: its words are stored, and scored as they are."""
    tokens = materialize(worded(posts.select("content_norm"), "content_norm").select("_words"), "tokens")
    tfidf = fit_tfidf(tokens, **limits)
    strongest = tfidf.strength(tokens).agg(F.max("tfidf_strength")).first()[0]
    return SignalModel(tfidf, float(strongest or 0.0))


def score_with_model(
    posts: DataFrame,
    model: SignalModel,
    bullish: list[str] = BULLISH,
    bearish: list[str] = BEARISH,
) -> DataFrame:
    """Score a batch or a stream with a frozen model: one pass, no shuffle and no state."""
    features = with_features(worded(posts, "content_norm"), model.tfidf, bullish, bearish).drop("_words")
    return with_signal(features, model.max_strength)


def score_posts(
    posts: DataFrame,
    bullish: list[str] = BULLISH,
    bearish: list[str] = BEARISH,
    columns: list[str] | None = None,
    **limits,
) -> DataFrame:
    """Fit on the posts and score them.

    The features are stored once, because the blend needs their maximum before the first row.
    ``columns`` limits what is stored beside them; without it every input column is kept.
    ``posts`` is read several times: pass a stored table. With ``columns`` it is read once: the words of the
    texts are stored with them, and the fit and the scores work on those.
    """
    if columns is not None:
        lexicon = signal.lexicon_score(F.col("content_norm"), bullish, bearish).alias("lexicon_score")
        weight = signal.engagement_weight(F.col("engagement")).alias("engagement_weight")
        cut = worded(posts, "content_norm").select(*columns, lexicon, weight, "_words")
        tokens = materialize(cut, "tokens")
        features = fit_tokens(tokens, **limits).strength(tokens)
        features = features.select(*columns, "lexicon_score", "tfidf_strength", "engagement_weight")
    else:
        features = with_features(worded(posts, "content_norm"), fit_tfidf(posts, **limits), bullish, bearish).drop("_words")
    stored = materialize(features, "features")
    return with_signal(stored, max_strength(stored))
