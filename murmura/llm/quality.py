"""Quality by regularised quadratic discriminant over transformed document statistics.

Class means and shrunk class covariances come from a bounded sample of labelled training rows; a score
is the logistic of the difference of the Mahalanobis log densities, with Cholesky factors kept.

Cases: a null text counts as empty and gets a score; null ids count as the empty text in the fold rule;
rows that repeat an id each get a row, and one of them is learned from; further columns are not read. With fewer than two training rows
of either class every score is the share of class 1 (0 without rows). An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import remainder
from murmura.llm.learning import Discriminant, byte_counts, labelled_sample
from murmura.llm.toxicity import score_column

MODULUS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: At most so many labelled rows are learned from; documented bound of the sample.
SAMPLE = 20_000

CAPITALS = list(range(65, 91))
SMALL = list(range(97, 123))
DIGITS = list(range(48, 58))
SYMBOLS = [ord(c) for c in "#*$%&|<>=+~^\\{}[]@_"]
SHOUTS = [ord(c) for c in "!?"]
STOPS = [ord(c) for c in ".,;:"]
HIGH = list(range(192, 256))
LOGIT = 1e-3


def _logit(share: float) -> float:
    return math.log((share + LOGIT) / (1 - min(share, 1.0) + LOGIT))


def statistics(text: str) -> list[float]:
    """Shares as log-odds, counts as logarithms."""
    words = text.split()
    n = len(words)
    counts = byte_counts(text)
    length = max(1, len(text))
    letters = counts[CAPITALS].sum() + counts[SMALL].sum() + counts[HIGH].sum()
    lines = [x for x in text.split("\n") if x.strip()]
    triples = set(zip(words, words[1:], words[2:]))
    return [
        math.log1p(n),
        math.log1p(sum(map(len, words)) / max(1, n)),
        _logit(counts[CAPITALS].sum() / max(1, letters)),
        _logit(counts[DIGITS].sum() / length),
        _logit(counts[SYMBOLS].sum() / length),
        _logit(counts[SHOUTS].sum() / length),
        _logit(counts[STOPS].sum() / length),
        _logit(letters / length),
        _logit(1 - len(set(lines)) / max(1, len(lines))),
        _logit(1 - len(triples) / max(1, n - 2)),
        math.log1p(n / max(1, len(lines))),
        math.log(len(set(words)) + 1) / math.log(n + 2),
    ]


class Model:
    def __init__(self, sample: DataFrame):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame(
                    {"doc_id": batch["doc_id"], "label": batch["label"], "x": [statistics(t) for t in batch["text"]]}
                )

        data = sample.mapInPandas(run, "doc_id long, label int, x array<double>").toPandas()  # the bounded sample
        y = data["label"].to_numpy(int)
        self.share = float(y.mean()) if len(y) else 0.0
        self.rule = None
        if min((y == 0).sum(), (y == 1).sum()) >= 2:
            self.rule = Discriminant().fit(np.array(data["x"].tolist(), float), y)

    def score(self, texts: list[str]) -> np.ndarray:
        if self.rule is None or not len(texts):
            return np.full(len(texts), self.share)
        margin = self.rule.margin(np.array([statistics(t) for t in texts], float))
        return 1 / (1 + np.exp(-np.clip(margin / 2, -30, 30)))  # half: the statistics are not independent


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    return Model(labelled_sample(docs, labels, "quality", MODULUS, HELD_OUT, bound))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` and ``predicted``. Map-only."""
    rows = docs.select(docs["doc_id"], score_column(model, docs["text"], docs.sparkSession).alias("score"))
    return rows.select(
        "doc_id",
        (remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
