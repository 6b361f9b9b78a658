"""Small numpy models that operators fit on bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import remainder, stored, whole


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, bound: int
) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of at most ``bound`` labelled rows outside the held-out remainder.

    Ids are chosen by their hash, so the choice is the same in every run. The chosen labels, at most
    ``bound`` rows, are broadcast. Of an id that several rows have, the text with the smallest hash counts,
    reduced on the map side, so no more rows come out than were chosen; they are stored for the passes over
    them. Rows without id or label don't count.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .where(remainder("doc_id", modulus) != held_out)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    rows = docs.select(docs["doc_id"], whole(docs["text"]).alias("text"))
    found = rows.join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    return stored(one.select("doc_id", "one.text", "label"), "labelled-sample")


def byte_counts(text: str) -> np.ndarray:
    """How often each byte occurs in the text; a million bytes at a time."""
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.zeros(256, np.int64)
    for at in range(0, len(data), 1 << 20):
        counts += np.bincount(data[at : at + (1 << 20)], minlength=256)
    return counts


class Trees:
    """Gradient-boosted trees of fixed depth on binned features, logistic loss, Newton leaves."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        quantiles = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(column, quantiles)) for column in x.T]
        binned = self._binned(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        margin, self.trees = np.full(len(y), self.base), []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            gradient, curvature = y - p, p * (1 - p)
            tree = self._grow(binned, gradient, curvature)
            self.trees.append(tree)
            margin += self._leaves(tree, binned)
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)], axis=1)

    def _grow(self, binned: np.ndarray, gradient: np.ndarray, curvature: np.ndarray):
        """Splits level by level: per node the feature and bin of the largest gain; then the leaf values."""
        node, splits = np.zeros(len(binned), np.int64), []
        for level in range(self.depth):
            n, best = 1 << level, None
            for f in range(binned.shape[1]):
                at = node * self.bins + binned[:, f]
                g = np.bincount(at, gradient, n * self.bins).reshape(n, -1).cumsum(1)
                h = np.bincount(at, curvature, n * self.bins).reshape(n, -1).cumsum(1)
                rest_g, rest_h = g[:, -1:] - g, h[:, -1:] - h
                gain = g**2 / (h + self.ridge) + rest_g**2 / (rest_h + self.ridge)
                gain = np.where((h > 1e-3) & (rest_h > 1e-3), gain, -np.inf)
                cut = gain.argmax(1)
                value = gain[np.arange(n), cut]
                if best is None:
                    best = [np.zeros(n, np.int64), cut, value]
                else:
                    better = value > best[2]
                    best = [np.where(better, f, best[0]), np.where(better, cut, best[1]), np.where(better, value, best[2])]
            splits.append((best[0], best[1]))
            node = 2 * node + (binned[np.arange(len(node)), best[0][node]] > best[1][node])
        g = np.bincount(node, gradient, 1 << self.depth)
        h = np.bincount(node, curvature, 1 << self.depth)
        return splits, self.rate * g / (h + self.ridge)

    def _leaves(self, tree, binned: np.ndarray) -> np.ndarray:
        splits, values = tree
        node = np.zeros(len(binned), np.int64)
        for features, cuts in splits:
            node = 2 * node + (binned[np.arange(len(node)), features[node]] > cuts[node])
        return values[node]

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        return self.base + sum(self._leaves(tree, binned) for tree in self.trees)


class Isotonic:
    """Least-squares monotone steps from scores to probabilities (pool adjacent violators)."""

    def fit(self, scores: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(scores, kind="stable")
        blocks: list[list[float]] = []  # sum, size, lowest score, highest score
        for score, value in zip(scores[order], y[order]):
            blocks.append([float(value), 1.0, float(score), float(score)])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                total, size, _, high = blocks.pop()
                blocks[-1][0] += total
                blocks[-1][1] += size
                blocks[-1][3] = high
        self.knots = np.array([x for b in blocks for x in (b[2], b[3])])
        self.values = np.array([v for b in blocks for v in [b[0] / b[1]] * 2])
        return self

    def predict(self, scores: np.ndarray) -> np.ndarray:
        return np.interp(scores, self.knots, self.values)


class Discriminant:
    """Quadratic discriminant with class covariances shrunk to the pooled one and to its diagonal."""

    def __init__(self, shrinkage: float = 0.15, ridge: float = 1e-2):
        self.shrinkage, self.ridge = shrinkage, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> Discriminant:
        self.centre, scale = x.mean(0), x.std(0)
        self.scale = np.where(scale > 0, scale, 1.0)
        z = (x - self.centre) / self.scale
        pooled = sum((y == c).sum() * np.cov(z[y == c], rowvar=False, bias=True) for c in (0, 1)) / len(y)
        target = 0.5 * pooled + 0.5 * np.diag(np.diag(pooled))
        self.classes = []
        for c in (0, 1):
            own = z[y == c]
            cov = (1 - self.shrinkage) * np.cov(own, rowvar=False, bias=True) + self.shrinkage * target
            factor = np.linalg.cholesky(cov + self.ridge * np.eye(len(cov)))  # kept for all later scores
            constant = np.log(len(own) / len(y)) - np.log(np.diag(factor)).sum()
            self.classes.append((own.mean(0), np.linalg.inv(factor), constant))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Difference of the log densities, class 1 less class 0, priors included."""
        z = (x - self.centre) / self.scale
        logs = [k - 0.5 * (((z - m) @ inverse.T) ** 2).sum(1) for m, inverse, k in self.classes]
        return logs[1] - logs[0]
