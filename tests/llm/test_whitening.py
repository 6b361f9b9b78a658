"""Whitening against fractions and numpy."""

import math
import random
from fractions import Fraction

import numpy as np

from murmura.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int, v string, d int"


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(i, v, 1, "x", 2, "v", 3) for i, v in zip(ids or range(len(vectors)), vectors)], SCHEMA)


def brute(vectors):
    """Covariance of the different vectors, in fractions."""
    xs = sorted({tuple(math.floor(256.0 * c) for c in v) for v in vectors})
    n, d = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(d)]
    centred = [[Fraction(n * x[i] - sums[i], n) for i in range(d)] for x in xs]
    cov = [[sum(c[i] * c[j] for c in centred) / n for j in range(d)] for i in range(d)]
    return n, sums, cov


def drawn(n, d, seed, spread=1.0):
    r = random.Random(seed)
    base = [[r.gauss(0, 1) for _ in range(d)] for _ in range(d)]
    out = []
    for _ in range(n):
        z = [r.gauss(0, 1) * spread / (k + 1) for k in range(d)]
        out.append([float(np.float32(3 + sum(z[k] * base[k][i] for k in range(d)))) for i in range(d)])
    return out


def check(spark, vectors, rows=None):
    n, sums, cov = brute(vectors)
    got = whitening.whitened(frame(spark, rows or vectors)).collect()
    d = len(sums)
    matrix = np.array([[float(c) for c in row] for row in cov])
    values = np.linalg.eigvalsh(matrix)[::-1]
    trace = float(sum(cov[i][i] for i in range(d)))
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == n and r.identity_error <= 1e-4
    for i, v in enumerate(vectors):
        x = [math.floor(256.0 * c) for c in v]
        e = [n * a - s for a, s in zip(x, sums)]
        parts = by.pop(i)
        assert sorted(parts) == list(range(1, min(4, d) + 1))
        for k, r in parts.items():
            assert r.deviation == sum(a * a for a in e)
            assert abs(r.explained - values[k - 1] / trace) <= 1e-9
        # The coordinates, scaled back, have the length of the projection on the leading subspace.
        if d <= 4:
            length = sum((r.whitened**2) * values[k - 1] for k, r in parts.items())
            assert abs(length - sum((a / n) ** 2 for a in e)) <= 1e-6 * max(1, length)
    assert not by
    w = np.array([[r.whitened for _, r in sorted(p.items())] for p in _rows(got)])
    return w, got


def _rows(got):
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    return by.values()


def test_covariances_are_exact():
    vectors = drawn(40, 5, 1)
    n, sums, cov = brute(vectors)
    x = np.array(sorted({tuple(math.floor(256.0 * c) for c in v) for v in vectors}))
    for offset in (0, 1 << 24, 1 << 50):  # longs, long squares, and numbers whose squares no long holds
        moved = x + np.arange(5) * offset + (x > x.mean()) * 0
        wide = moved * (1 << 21) if offset == 1 << 24 else moved
        centre = [whitening.round_half(int(s), n) for s in wide.sum(0)]
        got = whitening.covariances(n, 5, dict(whitening._squares(wide, centre)))
        scale = (1 << 42) if offset == 1 << 24 else 1
        assert np.array_equal(got, [[float(c * scale) for c in row] for row in cov])
    assert sum(v << (40 * k) for k, v in enumerate(whitening._limbs(-(1 << 190) + 12345))) == -(1 << 190) + 12345


def test_whitened_vectors(spark):
    vectors = drawn(300, 6, 2)
    w, _ = check(spark, vectors)
    assert np.abs(np.cov(w, rowvar=False, bias=True) - np.eye(4)).max() < 1e-6
    check(spark, drawn(50, 3, 3, spread=40.0))


def test_a_repeated_vector_counts_once_and_bad_rows_go(spark):
    vectors = drawn(30, 3, 4)
    vectors = vectors + [vectors[0]] * 200
    bad = [None, [1.0, None, 2.0], [float("nan"), 1.0, 2.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [], [3e38, 1.0, 1.0]]
    check(spark, vectors, vectors + bad)


def test_awkward_tables(spark):
    assert whitening.whitened(frame(spark, [])).count() == 0
    assert whitening.whitened(frame(spark, [[], [], None])).count() == 0
    for vectors in ([[1.0, 2.0]], [[1.0, 2.0]] * 3):
        got = whitening.whitened(frame(spark, vectors, [None] * len(vectors))).collect()
        assert {(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {
            (1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)
        } and len(got) == 2 * len(vectors)
    flat = whitening.whitened(frame(spark, [[1.0, 5.0], [2.0, 5.0]])).collect()  # no variance in one direction
    assert sorted((r.component, round(abs(r.whitened), 9), round(r.explained, 9), round(r.identity_error, 9)) for r in flat) == [
        (1, 1.0, 1.0, 0.0), (1, 1.0, 1.0, 0.0), (2, 0.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0)
    ]
    far = whitening.whitened(frame(spark, [[1e15, 0.0], [-1e15, 0.0], [0.0, 1.0]])).collect()
    assert {r.deviation for r in far} >= {None} and max(r.identity_error for r in far) <= 1e-4
