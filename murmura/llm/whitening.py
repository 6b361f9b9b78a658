"""Whitening of embeddings, with the covariance recovered from variances alone.

Entries are read as whole numbers, ``floor(256 * c)``. The covariance is that of the fit list, which holds every
different vector once. By polarisation, ``2 cov(a, b) = var(a + b) - var(a) - var(b)``: only sums of squared
centred values are aggregated, one for every dimension and one for the sum of every pair of dimensions. All are
whole numbers and exact: values are centred at the whole number next to the mean, so squares stay short, and the
rest of the mean, a fraction, is corrected exactly when the sums of the tasks are put together. The driver assembles
the matrix, as many numbers as pairs of dimensions whatever the rows, and takes its eigenvectors.

Cases: rows whose vector is null, or holds null, NaN, an infinity, or a number too large for a long are dropped, as
are vectors that haven't the table's most frequent length (of equally frequent ones the greatest); empty vectors have
no components. Rows that repeat a vector, or an id, all get their rows. Components without variance have ``explained``
and ``whitened`` 0 and don't count in ``identity_error``. A ``deviation`` that no long holds is null. Other columns
don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import stored

SCALE = 256.0
COMPONENTS = 4
#: Below it, the squares of sums of pairs of a million rows stay within a long; beyond, Python's integers are used.
SHORT = 1 << 20
#: Entries of a matrix that a task holds at a time.
CELLS = 1 << 22
#: Whole numbers travel as limbs of so many bits, whose sums over all tasks stay within a long.
LIMB, LIMBS = 40, 6
LONG = 1 << 63
SUMS = "n long, sums array<struct<i: int, j: int, limbs: array<long>>>"
RESULT = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def quantised(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and ``x``, the vector in whole numbers, of the rows with a whole vector of the usual length."""
    vector = embeddings["embedding"]
    largest = float(LONG // 512)
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < largest))
    rows = embeddings.where(vector.isNotNull() & good).select(embeddings["vec_id"], vector.alias("v"))
    size = F.size("v")
    usual = rows.groupBy(size.alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    x = F.transform("v", lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("long"))
    return rows.where(size == (usual.d if usual else 0)).select("vec_id", x.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of bounded size with their ``x`` as a matrix of longs."""
    for batch in batches:
        rows = CELLS // max(1, len(batch.column("x")[0])) + 1 if batch.num_rows else 1
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _less(x: np.ndarray, centre: list[int], factor: int = 1) -> np.ndarray:
    """``factor * x - centre`` exactly: as longs where they surely hold it, else as Python's integers."""
    largest = factor * int(max(abs(int(x.max())), abs(int(x.min())))) + max(map(abs, centre))
    kind = np.int64 if largest < LONG // 4 else object
    return factor * x.astype(kind) - np.array(centre, kind)


def _limbs(value: int) -> list[int]:
    """The value in limbs, the lowest first; only the last may be negative."""
    low = [(value >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(LIMBS - 1)]
    return [*low, value >> (LIMB * (LIMBS - 1))]


def _aggregated(vectors: DataFrame, task) -> tuple[int, dict[tuple[int, int], int]]:
    """Row count and whole-number sums by ``(i, j)`` over all tasks, each of which gives its sums once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, {}
        for _, x in _matrices(batches):
            n += len(x)
            if x.shape[1]:
                for key, value in task(x):
                    sums[key] = sums.get(key, 0) + value
        rows = [{"i": i, "j": j, "limbs": _limbs(v)} for (i, j), v in sums.items()]
        kind = pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32()), ("limbs", pa.list_(pa.int64()))]))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([rows], kind)], ["n", "sums"])

    parts = stored(vectors.select("x").mapInArrow(run, SUMS), "sums")
    n = parts.agg(F.sum("n")).first()[0] or 0
    each = parts.select(F.explode("sums").alias("s")).select("s.*")
    total = each.groupBy("i", "j").agg(*[F.sum(F.get("limbs", F.lit(k))).alias(f"l{k}") for k in range(LIMBS)])
    return n, {(r.i, r.j): sum(r[f"l{k}"] << (LIMB * k) for k in range(LIMBS)) for r in total.collect()}


def _totals(x: np.ndarray):
    largest = max(abs(int(x.max())), abs(int(x.min())))
    totals = (x if largest < LONG // len(x) else x.astype(object)).sum(0)
    return (((i, i), int(v)) for i, v in enumerate(totals))


def _squares(x: np.ndarray, centre: list[int]):
    """Sums of the centred values, at ``(-1, i)``, and of the squares of each dimension and each sum of two."""
    y = _less(x, centre)
    if max(abs(int(y.max())), abs(int(y.min()))) >= SHORT:
        y = y.astype(object)
    for i, total in enumerate(y.sum(0)):
        yield (-1, i), int(total)
    for i in range(y.shape[1]):
        pairs = y[:, i:] + y[:, i : i + 1]
        pairs[:, 0] = y[:, i]  # at (i, i) the dimension itself
        for j, total in enumerate((pairs * pairs).sum(0), i):
            yield (i, j), int(total)


@dataclass(frozen=True)
class Whitening:
    """The fit: size ``n`` of the fit list, sums of its dimensions, eigenvectors as rows, their eigenvalues."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def transformed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``n * x - sums``, exact, and the whitened coordinates."""
        centred = _less(x, self.sums, self.n)
        return centred, (centred / self.n).astype(float) @ self._scaled()

    def _scaled(self) -> np.ndarray:
        safe = np.where(self.values > 0, self.values, 1.0)
        return np.where(self.values > 0, self.vectors.T / np.sqrt(safe), 0.0)


def covariances(n: int, dims: int, squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix from sums of squares about whole numbers near the means, each entry rounded once."""
    rest = [squares[-1, i] for i in range(dims)]

    def centred(i: int, j: int) -> int:
        """n times the sum of the squares about the very mean, of a dimension or of the sum of two."""
        shift = rest[i] if i == j else rest[i] + rest[j]
        return n * squares[i, j] - shift * shift

    matrix = np.empty((dims, dims))
    for i in range(dims):
        matrix[i, i] = centred(i, i) / (n * n)
        for j in range(i + 1, dims):
            matrix[i, j] = matrix[j, i] = (centred(i, j) - centred(i, i) - centred(j, j)) / (2 * n * n)
    return matrix


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of ``x`` over ``vectors``, which is read twice: pass a stored table of different vectors."""
    n, totals = _aggregated(vectors, _totals)
    dims = len(totals)
    if not n or not dims:
        return Whitening(n, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    sums = [totals[i, i] for i in range(dims)]
    centre = [round_half(s, n) for s in sums]
    _, squares = _aggregated(vectors, lambda x: _squares(x, centre))
    matrix = covariances(n, dims, squares)
    values, columns = np.linalg.eigh(matrix)
    values, columns = values[::-1], columns[:, ::-1]
    trace = np.trace(matrix)
    # What rounding leaves of a variance of zero.
    values = np.where(values > dims * np.finfo(float).eps * max(values[0], 0.0), values, 0.0)[:components]
    explained = values / trace if trace > 0 else np.zeros(len(values))
    return Whitening(n, sums, columns.T[:components].copy(), values.copy(), explained)


def round_half(total: int, n: int) -> int:
    """The whole number next to ``total / n``, exactly."""
    return (2 * total + n) // (2 * n)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance less the identity, measured on all of them."""
    k = int((model.values > 0).sum())
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, means = np.zeros((k, k)), np.zeros(k)
        for _, x in _matrices(batches):
            w = model.transformed(x)[1][:, :k]
            products += w.T @ w
            means += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([[*products.ravel(), *means]], pa.list_(pa.float64()))], ["s"])

    parts = vectors.select("x").mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("at", "v"))
    sums = np.zeros(k * k + k)
    for row in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():
        sums[row["at"]] = row.v
    means = sums[k * k :] / model.n
    return float(np.abs(sums[: k * k].reshape(k, k) / model.n - np.outer(means, means) - np.eye(k)).max())


def _deviations(centred: np.ndarray) -> list[int | None]:
    largest = max(abs(int(centred.max())), abs(int(centred.min())))
    if largest * largest * centred.shape[1] < LONG:
        return (centred * centred).sum(1).tolist()
    return [v if v < LONG else None for v in (centred.astype(object) ** 2).sum(1).tolist()]


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: the whitened coordinate, beside the row's deviation and the fit's figures."""
    rows = stored(quantised(embeddings), "quantised")
    # Equal vectors are reduced on the map side, however many they are.
    vectors = stored(rows.select("x").distinct(), "fit-list")
    model = fit(vectors, components)
    error = identity_error(vectors, model)
    k = len(model.values)
    kind = pa.int64()
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches):
            if not k:
                continue
            centred, w = model.transformed(x)
            m = batch.num_rows
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(_deviations(centred), kind).take(pa.array(each)),
                    pa.array(w.ravel()),
                    pa.array(np.tile(model.explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names,
            )

    return rows.mapInArrow(run, RESULT.format(rows.schema["vec_id"].dataType.simpleString()))
