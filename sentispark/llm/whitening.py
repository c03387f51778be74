"""Whitened vectors from an exact characteristic polynomial.

Components are whole numbers here, ``floor(1024 * c) + 100000``, so the scatter matrix n * sum(x x') - S S' is one of whole
numbers too, and is summed exactly: every task multiplies its rows in doubles where no sum can pass 2^53, else in Python's
integers, and hands on limbs of 31 bits that Spark adds. It is n^2 times the covariance. Then

* its characteristic polynomial is found modulo many primes of 31 bits, by reduction to Hessenberg form, each prime in
  a task of Spark, and put together by Chinese remaindering; their number follows from a bound on the coefficients;
* all its roots are real, so the sign changes in the coefficients of p(x + a) count the roots above a exactly. Bisection
  by this count separates the roots wanted, then the sign of p at dyadic points narrows each one;
* inverse iteration on the matrix less a root, in decimal arithmetic of many digits, gives the null vector. Vectors of
  a repeated root are kept at right angles to those before; their choice within its null space is free.

The driver gets sums whose number follows from the dimension only, and one residue polynomial per prime. A second pass
projects every row; the covariance of what it made is measured by Spark's own aggregates.

Defined results: rows with a null vector, null or non-finite entries are left out, and rows of another dimension than most
(ties: the smaller one); zero vectors stay; rows that repeat an id are rows of their own; null ids stay. Components of
variance 0 have no whitened value and give no rows, so a table of equal vectors, like an empty one, gives an empty result.
``deviation`` is a decimal of 38 digits, null beyond. Other columns are not read.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from decimal import Context, Decimal, localcontext
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.llm.vectors import matrix
from sentispark.session import cut_lineage

SCALE, COMPONENTS = 1024, 8
#: Bits of a limb and limbs of a sum that a task hands on: 186 bits.
LIMB, LIMBS = 31, 6
#: Rows whose products are summed at once.
ROWS = 4096
#: Bits behind the point to which roots are narrowed, and how far two roots must lie apart to be told from one another.
BITS, APART = 128, 64
#: Digits beyond those of the matrix that inverse iteration works with, and its steps.
DIGITS, STEPS = 60, 3


def whole(vector: Column) -> Column:
    """The whole numbers of a vector, less the 100000, which no covariance feels; beyond 64 bits the nearest one."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long"))


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, x`` of the rows that take part."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    fit = df.where(v.isNotNull() & finite & (F.size(v) > 0)).select(F.col(id_col).alias("vec_id"), v.alias("vec"))
    common = fit.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fit.where(F.size("vec") == (common["n"] if common else 0)).select("vec_id", whole(F.col("vec")).alias("x"))


class Moments(NamedTuple):
    n: int
    sums: list[int]  # less n * 100000
    scatter: list[list[int]]  # n^2 times the covariance


def moments(rows: DataFrame) -> Moments:
    """Exact sums over all rows; d * (d + 3) / 2 + 1 numbers reach the driver."""
    names = [f"l{k}" for k in range(LIMBS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = _products(_integers(batch.column("x").slice(at, ROWS)))
                total = part if total is None else total + part
        if total is not None:
            limbs = [[(int(v) >> LIMB * k) & ((1 << LIMB) - 1) if k < LIMBS - 1 else int(v) >> LIMB * k for v in total] for k in range(LIMBS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), *(pa.array(x, pa.int64()) for x in limbs)], ["k", *names])

    parts = rows.select("x").mapInArrow(run, ", ".join(["k long", *(f"{n} long" for n in names)]))
    found = parts.groupBy("k").agg(*[F.sum(n).alias(n) for n in names]).collect()
    value = {r["k"]: sum(r[n] << LIMB * k for k, n in enumerate(names)) for r in found}
    if not value:
        return Moments(0, [], [])
    d = (math.isqrt(8 * len(value) + 1) - 3) // 2
    n, sums = value[0], [value[1 + i] for i in range(d)]
    scatter = [[0] * d for _ in range(d)]
    for k, (i, j) in enumerate(zip(*np.triu_indices(d)), 1 + d):
        scatter[i][j] = scatter[j][i] = n * value[k] - sums[i] * sums[j]
    return Moments(n, sums, scatter)


def _integers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _products(x: np.ndarray) -> np.ndarray:
    """Number of rows, column sums and the upper triangle of x'x as Python integers."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    exact = most * most * len(x) < 1 << 53
    y = x.astype(np.float64 if exact else object)
    gram = y.T @ y
    flat = np.concatenate(([len(x)], y.sum(axis=0), gram[np.triu_indices(x.shape[1])]))
    return (flat.astype(np.int64) if exact else flat).astype(object)


# --- the characteristic polynomial ---------------------------------------------------------------------------------


def primes(bits: int) -> list[int]:
    """Primes below 2^31, from the largest down, whose product has more than ``bits`` bits."""
    out, have, n = [], 0.0, (1 << 31) - 1
    while have <= bits + 1:
        if _is_prime(n):
            out.append(n)
            have += math.log2(n)
        n -= 2
    return out


def _is_prime(n: int) -> bool:
    """Exact below 3 * 10^9 with these three bases, for odd n."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``a`` modulo p with zeros below its first subdiagonal."""
    a = a % p
    d = len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1:, k])
        if not len(below):
            continue
        if (pivot := k + 1 + int(below[0])) != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        factor = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - factor[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * factor % p).sum(axis=1)) % p
    return a


def polynomial_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(xI - a) modulo p, constant first."""
    h = hessenberg(a, p)
    d = len(h)
    found = np.zeros((d + 1, d + 1), np.int64)
    found[0, 0] = 1
    for k in range(1, d + 1):
        found[k, 1:] = found[k - 1, :-1]
        weight, product = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):  # the subdiagonals below h[i, k - 1], multiplied up
            weight[i] = int(h[i, k - 1]) * product % p
            product = product * int(h[i, i - 1]) % p if i else 0
        found[k] = (found[k] - (weight[:, None] * found[:k] % p).sum(axis=0)) % p
    return found[d]


def coefficient_bits(scatter: list[list[int]]) -> int:
    """Bits that no coefficient passes: of roots that are not negative, the k-th is at most C(d, k) (trace / d)^k."""
    d = len(scatter)
    mean = -(-sum(scatter[i][i] for i in range(d)) // d)
    return max((math.comb(d, k) * mean ** k).bit_length() for k in range(d + 1)) + 1


def characteristic_polynomial(spark: SparkSession, scatter: list[list[int]]) -> list[int]:
    """Its coefficients, constant first; every prime is a row of a table that Spark deals out."""
    d = len(scatter)
    chosen = primes(coefficient_bits(scatter))
    rows = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(min(len(chosen), spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("p").to_pylist():
                a = np.array([[v % p for v in row] for row in scatter], np.int64)
                yield pa.RecordBatch.from_pydict({"p": pa.array([p], pa.int64()),
                                                  "c": pa.array([polynomial_modulo(a, p).tolist()], pa.list_(pa.int64()))})

    found = {r["p"]: r["c"] for r in rows.mapInArrow(run, "p long, c array<long>").collect()}
    whole_, modulus = [0] * (d + 1), 1
    for p, residues in sorted(found.items()):
        back = pow(modulus, -1, p)
        whole_ = [w + modulus * ((r - w) * back % p) for w, r in zip(whole_, residues)]
        modulus *= p
    return [w - modulus if 2 * w > modulus else w for w in whole_]


# --- its roots -----------------------------------------------------------------------------------------------------


def roots_above(c: list[int], at: int, bits: int = 0) -> int:
    """How many roots exceed ``at / 2^bits``, repeated ones counted as often; all roots are real."""
    d = len(c) - 1
    shifted = [v << bits * (d - k) for k, v in enumerate(c)]  # of 2^bits times the roots
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            shifted[k] += at * shifted[k + 1]
    signs = [v > 0 for v in shifted if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(c: list[int], at: int, bits: int) -> int:
    value, d = 0, len(c) - 1
    for k in range(d, -1, -1):
        value = value * at + (c[k] << bits * (d - k))
    return (value > 0) - (value < 0)


def largest_roots(c: list[int], count: int) -> list[int]:
    """The largest roots times 2^BITS, falling; a repeated root stands as often as it is one.

    A simple root is met within a unit, those less than 2^-APART from another or from a dyadic number within 2^-APART.
    """
    top = 1 << max(v.bit_length() for v in c)  # beyond all roots: none exceeds the trace
    top = min(top, abs(c[-2]) + 1)
    out: list[int] = []
    seen: dict[tuple[int, int], int] = {}

    def above(at: int, bits: int) -> int:
        key = (at << APART - bits, APART)
        if key not in seen:
            seen[key] = roots_above(c, at, bits)
        return seen[key]

    for k in range(1, count + 1):
        low, high, bits = 0, top, 0  # more than k - 1 roots above low (or low = 0), fewer than k above high
        while True:
            alone = above(low, bits) == k and above(high, bits) == k - 1
            if alone and _sign(c, low, bits) * _sign(c, high, bits) < 0:
                low, high, bits = _narrow(c, low, high, bits)
                break
            if high - low <= 1:
                if bits == APART:
                    break
                low, high, bits = 2 * low, 2 * high, bits + 1
            middle = (low + high) // 2
            low, high = (middle, high) if above(middle, bits) >= k else (low, middle)
        out.append((low + high) << BITS - bits - 1)
    return out


def _narrow(c: list[int], low: int, high: int, bits: int) -> tuple[int, int, int]:
    """An interval with one simple root and a change of sign, down to a unit of 2^-(BITS - 1)."""
    sign = _sign(c, high, bits)
    while high - low > 1 or bits < BITS - 1:
        if high - low <= 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        at = _sign(c, middle, bits)
        if at == 0:
            return middle, middle, bits
        low, high = (low, middle) if at == sign else (middle, high)
    return low, high, bits


# --- components ----------------------------------------------------------------------------------------------------


def components(scatter: list[list[int]], roots: list[int]) -> np.ndarray:
    """Unit vectors as rows, one per root, at right angles to one another; the sign of the largest entry is positive."""
    digits = DIGITS + 2 * len(str(max(abs(v) for row in scatter for v in row)))
    found: list[np.ndarray] = []
    with localcontext(Context(prec=digits, Emax=10 ** 9, Emin=-10 ** 9)):
        whole_ = np.array([[Decimal(v) for v in row] for row in scatter], object)
        for root in roots:
            moved = whole_.copy()
            moved[np.diag_indices(len(moved))] -= Decimal(root) / Decimal(1 << BITS)
            solve = _factors(moved, Decimal(10) ** -digits * whole_.max())
            draw = random.Random(len(found))
            v = np.array([Decimal(draw.randrange(1, 1000)) for _ in scatter], object)
            for _ in range(STEPS):
                v = _unit(_apart(v, found))
                v = _unit(_apart(_unit(solve(v)), found))
            largest = max(range(len(v)), key=lambda i: abs(v[i]))
            found.append(v if v[largest] > 0 else -v)
    return np.array([[float(x) for x in v] for v in found]).reshape(len(found), len(scatter))


def _apart(v: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for f in found:
        v = v - f * (v @ f)
    return v


def _unit(v: np.ndarray) -> np.ndarray:
    return v / (v @ v).sqrt()


def _factors(a: np.ndarray, least: Decimal):
    """Gaussian elimination with row exchange; a pivot of 0 becomes ``least``. Returns the solver."""
    a, d, order = a.copy(), len(a), list(range(len(a)))
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(a[i, k]))
        if best != k:
            a[[k, best]] = a[[best, k]]
            order[k], order[best] = order[best], order[k]
        if abs(a[k, k]) < least:
            a[k, k] = least
        a[k + 1:, k] /= a[k, k]
        a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])

    def solve(b: np.ndarray) -> np.ndarray:
        x = b[order].copy()
        for k in range(d):
            x[k + 1:] -= a[k + 1:, k] * x[k]
        for k in range(d - 1, -1, -1):
            x[k] /= a[k, k]
            x[:k] -= a[:k, k] * x[k]
        return x

    return solve


class Whitening(NamedTuple):
    n: int
    sums: list[int]
    axes: np.ndarray  # a component per row
    scale: list[float]  # square root of each component's variance
    explained: list[float]


def fit(rows: DataFrame, count: int = COMPONENTS) -> Whitening:
    """From ``vec_id, x``: the components of largest variance, at most ``count``, none of variance 0."""
    m = moments(rows)
    trace = sum(m.scatter[i][i] for i in range(len(m.scatter)))
    if not trace:
        return Whitening(m.n, m.sums, np.zeros((0, len(m.sums))), [], [])
    polynomial = characteristic_polynomial(rows.sparkSession, m.scatter)
    positive = len(polynomial) - 1 - next(k for k, v in enumerate(polynomial) if v)  # 0 is a root as often as low terms lack
    roots = largest_roots(polynomial, min(count, positive))
    one = 1 << BITS
    with localcontext(Context(prec=80)):
        scale = [float((Decimal(r) / one).sqrt() / m.n) for r in roots]
        explained = [float(Decimal(r) / one / trace) for r in roots]
    return Whitening(m.n, m.sums, components(m.scatter, roots), scale, explained)


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened``: the squared distance from the mean times n^2, and the coordinates on the components."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    axes = model.axes / np.array(model.scale)[:, None] if len(model.scale) else model.axes
    sums, n = np.array(model.sums, object), model.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = _integers(part.column("x"))
                most = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums))
                small = most < 1 << 62
                away = n * x - sums.astype(np.int64) if small else n * x.astype(object) - sums
                squares = away if most * most * x.shape[1] < 1 << 63 else away.astype(object)
                far = [v if abs(v) < 10 ** 38 else None for v in map(int, (squares * squares).sum(axis=1))]
                made = (away / n).astype(np.float64) @ axes.T
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array([None if v is None else Decimal(v) for v in far], pa.decimal128(38, 0)),
                     pa.array(list(made), pa.list_(pa.float64()))], ["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(run, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(projected: DataFrame, count: int) -> float:
    """The largest entry of the covariance of what was made, less the identity."""
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    w = F.col("whitened")
    found = projected.agg(*[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max((abs(v - (i == j)) for (i, j), v in zip(pairs, found)), default=0.0)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component, components from 1."""
    rows = usable(df, id_col, vec_col)
    model = fit(rows, count)
    made = cut_lineage(project(rows, model))
    found = len(model.scale)
    error = identity_error(made, found) if found else 0.0
    explained = F.array(*map(F.lit, model.explained)) if found else F.array().cast("array<double>")
    each = made.select("vec_id", "deviation", F.posexplode(F.arrays_zip(F.col("whitened"), explained.alias("explained"))).alias("k", "v"))
    return each.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                       F.col("v.whitened").alias("whitened"), F.col("v.explained").alias("explained"), F.lit(error).alias("identity_error"))
