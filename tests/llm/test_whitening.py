"""The polynomial against fractions, roots against known ones, components and whitened values against numpy."""

import random
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

import fixtures
from sentispark.llm import queries
from sentispark.llm import whitening as wh


def plain_polynomial(a):
    """By Faddeev and LeVerrier in fractions, constant first."""
    d = len(a)
    m, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(a[i][t] * m[t][i] for i in range(d) for t in range(d)) / k)
    return [int(x) for x in c[::-1]]


def scatter_of(rng, n, d, size=1000):
    x = [[rng.randrange(-size, size) for _ in range(d)] for _ in range(n)]
    s = [sum(r[i] for r in x) for i in range(d)]
    return [[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("n, d, size", [(1, 3, 10), (2, 4, 10), (3, 6, 100), (40, 1, 9), (30, 7, 10 ** 6), (5, 5, 10 ** 12), (9, 2, 2)])
def test_polynomial(spark, n, d, size):
    a = scatter_of(random.Random(n * d), n, d, size)
    assert wh.characteristic_polynomial(spark, a) == plain_polynomial(a)


def test_polynomial_of_matrices_with_zeros(spark):
    for a in ([[0, 0], [0, 0]], [[2, 0, 0], [0, 2, 0], [0, 0, 5]], [[1, 0, 0, 1], [0, 0, 0, 0], [0, 0, 3, 0], [1, 0, 0, 1]]):
        assert wh.characteristic_polynomial(spark, a) == plain_polynomial(a)


def product_of(roots):
    c = [1]
    for r in roots:
        c = [(c[k - 1] if k else 0) - r * (c[k] if k < len(c) else 0) for k in range(len(c) + 1)]
    return c


@pytest.mark.parametrize("roots", [[1, 2, 3, 4], [5, 5, 5, 2], [0, 0, 7], [10 ** 15, 10 ** 15 + 1, 3], [6, 6, 4, 4, 1, 0], [1], [10 ** 30, 1]])
def test_known_roots(roots):
    c = product_of(roots)
    falling = sorted((r for r in roots if r), reverse=True)
    for at in {0, 1, 2, 5, 10 ** 15}:
        assert wh.roots_above(c, at) == sum(r > at for r in roots)
    for got, want in zip(wh.largest_roots(c, len(falling)), falling, strict=True):
        assert abs(Fraction(got, 1 << wh.BITS) - want) <= Fraction(1, 1 << wh.APART)


def test_simple_roots_to_the_last_bit():
    c = [-2, 0, 1]  # the roots of 2 and its negative: the sign test alone narrows
    low, high, bits = wh._narrow(c, 1, 2, 0)
    assert low ** 2 < 2 << 2 * bits < high ** 2 and high - low == 1 and bits == wh.BITS - 1


@pytest.mark.parametrize("a", [[[3, 0, 0], [0, 3, 0], [0, 0, 1]], [[2, 1], [1, 2]], [[4, 4, 0], [4, 4, 0], [0, 0, 8]],
                               scatter_of(random.Random(8), 30, 12), scatter_of(random.Random(9), 4, 9)])
def test_components_are_unit_eigenvectors(spark, a):
    c = wh.characteristic_polynomial(spark, a)
    roots = wh.largest_roots(c, next(len(c) - 1 - k for k, v in enumerate(c) if v))
    v = wh.components(a, roots)
    assert np.allclose(v @ v.T, np.eye(len(roots)), atol=1e-14)
    scale = max(abs(x) for row in a for x in row)
    for row, root in zip(v, roots):
        assert np.abs(np.array(a, float) @ row - root / (1 << wh.BITS) * row).max() <= 1e-13 * scale * len(a)


def test_near_equal_roots_keep_their_vectors(spark):
    """Eigenvalues 2e12 + 1, 2e12 and 2e12 - 1: double arithmetic would mix their vectors."""
    a = [[2 * 10 ** 12, 1, 0], [1, 2 * 10 ** 12, 0], [0, 0, 2 * 10 ** 12]]
    roots = wh.largest_roots(wh.characteristic_polynomial(spark, a), 3)
    half = 2 ** -0.5
    assert np.allclose(np.abs(wh.components(a, roots)), [[half, half, 0], [0, 0, 1], [half, half, 0]], atol=1e-15)


def frame(spark, vectors):
    return spark.createDataFrame([(k, v, "x", 1) for k, v in enumerate(vectors)],
                                 "vec_id long, embedding array<double>, whitened string, n int")


def by_numpy(vectors):
    x = np.floor(1024 * np.array(vectors)).astype(np.int64)
    n, s = len(x), x.sum(0)
    values, axes = np.linalg.eigh((x - s / n).T @ (x - s / n) / n)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    return (x - s / n) @ axes / np.sqrt(values), values, ((n * x - s) ** 2).sum(1)


def test_same_as_numpy(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(300, 20)) * np.linspace(1, 4, 20) @ rng.normal(size=(20, 20))).tolist()
    odd = [None, [float("nan")] * 20, [float("inf")] + [0.0] * 19, [None] + [1.0] * 19, [1.0, 2.0]]
    got = wh.whiten(frame(spark, vectors + odd)).orderBy("vec_id", "component").collect()
    want, values, far = by_numpy(vectors)
    made = np.array([r.whitened for r in got]).reshape(300, 8)
    sign = np.sign((made * want).sum(0))
    assert np.abs(made - want * sign).max() < 1e-9
    assert [r.component for r in got] == list(range(1, 9)) * 300 and {r.n for r in got} == {300}
    assert [int(r.deviation) for r in got[::8]] == far.tolist()
    assert got[0].identity_error < 1e-9 and len({r.identity_error for r in got}) == 1
    total = np.trace(np.cov(np.floor(1024 * np.array(vectors)).T, bias=True))
    assert np.allclose([r.explained for r in got[:8]], values / total, rtol=1e-12)


def test_sums_beyond_doubles(spark):
    """Products that no double and no 64-bit number holds."""
    rng = random.Random(6)
    vectors = [[rng.choice([-1, 1]) * rng.random() * 10 ** rng.choice([1, 12]) for _ in range(4)] for _ in range(50)]
    rows = wh.usable(frame(spark, vectors), "vec_id", "embedding")
    x = [[int(v) for v in r.x] for r in rows.collect()]
    n, s = len(x), [sum(r[i] for r in x) for i in range(4)]
    m = wh.moments(rows)
    assert m.n == n and m.sums == s
    assert m.scatter == [[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(4)] for i in range(4)]
    got = {r.vec_id: r.deviation for r in wh.whiten(frame(spark, vectors)).where("component = 1").collect()}
    by_id = {r.vec_id: r.x for r in rows.collect()}
    assert got == {k: Decimal(sum((n * v - t) ** 2 for v, t in zip(by_id[k], s))) for k in by_id}


@pytest.mark.parametrize("vectors, count", [([[1.0, 2.0]], 0), ([[1.0, 2.0]] * 9, 0), ([[0.0, 0.0], [1.0, 2.0]], 1), ([], 0), ([None], 0),
                                            ([[1.0], [2.0], [2.0]], 1), ([[0.0] * 3, [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]], 3)])
def test_fewer_components_than_eight(spark, vectors, count):
    got = wh.whiten(frame(spark, vectors)).collect()
    assert len(got) == count * sum(v is not None for v in vectors)
    assert all(r.identity_error < 1e-9 for r in got)


def test_registered_query(spark, tables):
    got = queries.QUERIES["op13_whitening"](spark, tables).orderBy("vec_id", "component").collect()
    vectors = {k: v for k, v in fixtures.vectors() if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want, _, far = by_numpy([[float(np.float32(x)) for x in v] for v in vectors.values()])
    made = np.array([r.whitened for r in got]).reshape(len(vectors), 8)
    assert np.abs(made - want * np.sign((made * want).sum(0))).max() < 1e-9
    assert [(r.vec_id, r.deviation) for r in got[::8]] == list(zip(vectors, far.tolist()))
