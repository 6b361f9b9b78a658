"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and word openings is counted from a bounded sample of labelled training rows; its
densities, how near its hits are to second-person words, and rates of capitals, punctuation and
obfuscated spelling feed small trees. Out-of-fold margins of the trees give the calibration.

Cases: a null text counts as empty and gets a score; null ids count as the empty text in the fold rule;
rows that repeat an id each get a row, and one of them is learned from. Without labelled training rows, or with one class only, every
score is that class's share (0 without rows). Labels of an id that disagree count as toxic. Further
columns pass through :func:`clean` and are not read otherwise. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import remainder, whole
from murmura.llm.learning import Isotonic, Trees, byte_counts, labelled_sample

MODULUS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: At most so many labelled rows are learned from; documented bound of the sample.
SAMPLE = 20_000
#: Words of a text that are looked at together.
NEAR = 3
OPENINGS = (4, 5)
#: Different terms that a task counts before it hands them on.
HELD_TERMS = 100_000

SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch sie tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split()
)
WORDS = re.compile(r"[^\W\d_]+")
OBFUSCATED = re.compile(r"[^\W\d_][*@$#+!\d]+[^\W\d_]|([^\W\d_])\1\1")
PUNCTUATION = [ord(c) for c in "!\"'(),-./:;?[]_{}"]
SHOUTS = [ord(c) for c in "!?"]
CAPITALS = list(range(65, 91))
LETTERS = CAPITALS + list(range(97, 123)) + list(range(0xC3, 0xC6))


def terms(words: list[str]) -> list[str]:
    """Each word and its openings; an opening ends with a dash."""
    return [*words, *[w[:n] + "-" for n in OPENINGS for w in words if len(w) > n]]


def term_rows(rows: Iterable[tuple[str, int]], held: int = HELD_TERMS) -> Iterator[pd.DataFrame]:
    """``term``, ``toxic`` and ``rows``: in how many of the texts each term is, in parts of about ``held`` terms.

    No more than that and one text's terms are held at a time, however many texts there are.
    """

    def part() -> pd.DataFrame:
        columns = [list(counts), [n[0] for n in counts.values()], [n[1] for n in counts.values()]]
        return pd.DataFrame(dict(zip(("term", "toxic", "rows"), columns))).astype({"term": "str", "toxic": "int64", "rows": "int64"})

    counts: dict[str, list[int]] = {}
    for text, label in rows:
        for term in set(terms(WORDS.findall(text.lower()))):
            seen = counts.setdefault(term, [0, 0])
            seen[0] += label
            seen[1] += 1
        if len(counts) >= held:
            yield part()
            counts.clear()
    if counts:
        yield part()


def count_lexicon(sample: DataFrame) -> tuple[dict[str, tuple[int, int]], int, int]:
    """Rows with each term, toxic and not, of all terms that stand out; and the rows of each class.

    The sample's bound is the lexicon's: a term stands out in three of its toxic rows at least.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from term_rows((text, int(y)) for batch in batches for text, y in zip(batch["text"], batch["label"]))

    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}, toxic, clean
    counted = (
        sample.select("text", "label")
        .mapInPandas(run, "term string, toxic long, rows long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("rows").alias("rows"))
        .withColumn("clean", F.col("rows") - F.col("toxic"))
        .where(f"toxic >= 3 and (toxic + 0.5) / {toxic + 1} > 4 * (clean + 0.5) / {clean + 1}")
    )
    return {r["term"]: (r["toxic"], r["clean"]) for r in counted.collect()}, toxic, clean


class Lexicon:
    def __init__(self, counts: dict[str, tuple[int, int]], toxic: int, clean: int):
        self.counts, self.toxic, self.clean = counts, toxic, clean
        self.weights = {t: self._weight(*n) for t, n in counts.items()}

    def _weight(self, toxic: float, clean: float) -> float:
        return math.log((toxic + 0.5) / (self.toxic + 1)) - math.log((clean + 0.5) / (self.clean + 1))

    def weight(self, term: str, label: int | None) -> float:
        """The term's log-odds; for a row it was counted on, without that row."""
        if label is None:
            return self.weights[term]
        toxic, clean = self.counts[term]
        toxic, clean = toxic - label, clean - (1 - label)
        return self._weight(toxic, clean) if toxic >= 2 else 0.0

    def features(self, text: str, label: int | None = None) -> list[float]:
        words = WORDS.findall(text.lower())
        n, known = len(words), self.weights
        hits = [(i, self.weight(w, label)) for i, w in enumerate(words) if w in known]
        opened = [self.weight(o, label) for k in OPENINGS for w in words if len(w) > k and (o := w[:k] + "-") in known]
        near = sum(any(w in SECOND_PERSON for w in words[max(0, i - NEAR) : i + NEAR + 1]) for i, _ in hits)
        counts = byte_counts(text)
        length = max(1, len(text))
        word_weights = [w for _, w in hits]
        return [
            sum(word_weights) / (n + 10),
            sum(opened) / (n + 10),
            max(word_weights, default=0.0),
            max(opened, default=0.0),
            sum(w > 2 for w in word_weights),
            sum(w > 2 for w in opened),
            near / (n + 10),
            counts[CAPITALS].sum() / max(1, counts[LETTERS].sum()),
            counts[SHOUTS].sum() / length,
            counts[PUNCTUATION].sum() / length,
            len(OBFUSCATED.findall(text)) / (n + 10),
            math.log1p(n),
        ]


class Model:
    """Lexicon, trees and calibration."""

    def __init__(self, sample: DataFrame):
        self.lexicon = Lexicon(*count_lexicon(sample))
        toxic, clean = self.lexicon.toxic, self.lexicon.clean
        self.share = toxic / max(1, toxic + clean)
        self.trees = None
        if min(toxic, clean) < 2:
            return
        lexicon = self.lexicon

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [lexicon.features(t, y) for t, y in zip(batch["text"], batch["label"])]
                yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": rows})

        data = sample.mapInPandas(run, "doc_id long, label int, x array<double>").toPandas()  # the bounded sample
        data["text"] = data["x"].map(str)
        data = data.sort_values(["doc_id", "text"], kind="stable")
        x, y = np.array(data["x"].tolist(), float), data["label"].to_numpy(float)
        fold = np.arange(len(y)) % 2
        margins = np.zeros(len(y))
        for f in (0, 1):
            margins[fold == f] = Trees().fit(x[fold != f], y[fold != f]).margin(x[fold == f])
        self.trees, self.calibration = Trees().fit(x, y), Isotonic().fit(margins, y)

    def score(self, texts: list[str]) -> np.ndarray:
        if self.trees is None or not len(texts):
            return np.full(len(texts), self.share)
        margin = self.trees.margin(np.array([self.lexicon.features(t) for t in texts], float))
        # A little of the margin itself keeps the order inside the steps of the calibration.
        return np.clip(0.98 * self.calibration.predict(margin) + 0.02 / (1 + np.exp(-margin)), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    return Model(labelled_sample(docs, labels, "toxic", MODULUS, HELD_OUT, bound))


def score_column(model, text: Column, spark) -> Column:
    """The score of each text; the model, of bounded size, goes to the executors as a broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [shared.value.score(list(texts[at : at + 512])) for at in range(0, len(texts), 512)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return run(whole(text))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` and ``predicted``. Map-only."""
    rows = docs.select(docs["doc_id"], score_column(model, docs["text"], docs.sparkSession).alias("score"))
    return rows.select(
        "doc_id",
        (remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are not toxic, with all their columns."""
    return docs.where(score_column(model, docs["text"], docs.sparkSession) < THRESHOLD)
