"""Whitening of vectors from the exact characteristic polynomial of their scatter.

Vectors become integers, ``x = floor(scale * c)``. The fit list holds each
distinct x once: n of them with sums S. Their scatter times n, ``M = n * sum(x x')
- S S'``, is a matrix of whole numbers and equals n*n times the covariance V, so
nothing about it has to be rounded:

1. Spark adds up n, S and ``sum(x x')`` (one partial sum per task) as decimals.
2. The characteristic polynomial of M has whole coefficients, whose size is
   bounded by the trace. It is computed modulo enough primes under 2**31, by
   reducing M to Hessenberg form in each prime field, and put together by Chinese
   remaindering. The primes are dealt over Spark tasks.
3. All roots are real, so the sign changes of the polynomial moved by t count
   exactly the roots above t (with multiplicity). Bisection on whole numbers
   encloses each of the largest roots to ``ROOT_BITS`` bits.
4. A component spans the null space of ``M - root * I``: inverse iteration with
   decimals of ``DIGITS`` digits. Roots that cannot be told apart at that
   precision share a space, whose vectors are made orthogonal.

What comes to the driver is bounded by the number of dimensions. Edge cases:
rows whose vector is null or holds null, NaN or infinite components are left
out. Vectors of another length than the most frequent one (the shorter on a tie)
are returned with null values, and count nowhere. Components without variance
cannot be whitened: there are as many components as the rank allows, none where
all vectors are equal (then no rows are returned). Repeated vectors weigh once;
repeated and null ids are rows of their own. An empty table gives no rows.
Integers of 2**31 or more in size are refused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundtrail.llm.ballcodes import finite
from fundtrail.session import materialize, release

MAX_COMPONENT = (1 << 31) - 1
ROOT_BITS = 128
DIGITS = 80
PRIMES_PER_TASK = 16
_WHOLE = pa.decimal128(38, 0)


# ------------------------------------------------ polynomial


def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every number under 3.4e14."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7, 11, 13, 17):
        if n % base == 0:
            return n == base
        y = pow(base, odd, n)
        if y in (1, n - 1):
            continue
        for _ in range(twos - 1):
            y = y * y % n
            if y == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes under 2**31, as many as needed for their product to exceed ``bound``."""
    found, product, candidate = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(candidate):
            found.append(candidate)
            product *= candidate
        candidate -= 2
    return found


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``a`` over the field of ``p`` with zeros below the first subdiagonal."""
    a = a % p
    d = len(a)
    for m in range(1, d - 1):
        below = np.flatnonzero(a[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        if i != m:
            a[[m, i]] = a[[i, m]]
            a[:, [m, i]] = a[:, [i, m]]
        factors = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        if not factors.any():
            continue
        a[m + 1 :] = (a[m + 1 :] - factors[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * factors % p).sum(axis=1)) % p
    return a


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(xI - matrix) mod ``p``, the constant first. ``matrix`` holds whole numbers of any size."""
    d = len(matrix)
    h = hessenberg((matrix % p).astype(np.int64), p)
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):
        # expand along the last column of the leading block
        new = np.zeros(d + 1, np.int64)
        new[1:] = polys[k, :-1]
        new -= h[k, k] * polys[k] % p
        weights, run = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            run = run * int(h[i + 1, i]) % p
            if not run:
                break
            weights[i] = run * int(h[i, k]) % p
        if k:
            new -= (weights[:, None] * polys[:k] % p).sum(axis=0)
        polys[k + 1] = new % p
    return polys[d]


def remainders_to_whole(residues: list[np.ndarray], primes: list[int]) -> list[int]:
    """The whole numbers nearest to zero with these remainders."""
    values, product = [0] * len(residues[0]), 1
    for row, p in zip(residues, primes, strict=True):
        inverse = pow(product, -1, p)
        values = [v + product * ((int(r) - v) * inverse % p) for v, r in zip(values, row, strict=True)]
        product *= p
    return [v - product if 2 * v > product else v for v in values]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact coefficients of det(xI - matrix), the constant first, for a symmetric
    matrix (object array) of whole numbers without negative roots."""
    d, trace = len(matrix), sum(matrix[i, i] for i in range(len(matrix)))
    # a coefficient is a sum of products of roots, largest where all roots are equal
    bound = max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    primes = primes_beyond(2 * bound + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [polynomial_mod(matrix, primes[k]).tolist() for k in batch.column("id").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(rows, pa.list_(pa.int64()))], ["id", "residues"]
            )

    tasks = -(-len(primes) // PRIMES_PER_TASK)
    found = spark.range(0, len(primes), 1, tasks).mapInArrow(run, "id long, residues array<long>").toArrow()
    by_prime = dict(zip(found.column("id").to_pylist(), found.column("residues").to_pylist(), strict=True))
    return remainders_to_whole([by_prime[k] for k in range(len(primes))], primes)


# ------------------------------------------------ roots and components


def roots_above(polynomial: list[int], a: int, shift: int) -> int:
    """The number of roots above ``a / 2**shift`` of a polynomial (constant first) whose roots are all real."""
    d = len(polynomial) - 1
    c = [v << (shift * (d - k)) for k, v in enumerate(polynomial)]
    for low in range(d):
        for k in range(d - 1, low - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))  # noqa: B905


def largest_roots(polynomial: list[int], k: int) -> list[tuple[int, int, int]]:
    """(low, high, shift) with the i-th largest root in (low, high] / 2**shift, for the ``k``
    largest roots, or all positive ones where there are fewer. Roots must be real and not negative."""
    zeros = next(i for i, v in enumerate(polynomial) if v)
    polynomial = polynomial[zeros:]
    d = len(polynomial) - 1
    if d < 1:
        return []
    found = []
    top = -polynomial[-2]  # the sum of the roots
    for i in range(1, min(k, d) + 1):
        low, high, shift = 0, top, 0
        while (high - low) << ROOT_BITS > low:
            if high - low == 1:
                low, high, shift = low << 64, high << 64, shift + 64
            middle = (low + high) // 2
            if roots_above(polynomial, middle, shift) >= i:
                low = middle
            else:
                high = middle
        found.append((low, high, shift))
    return found


def _factor(a: np.ndarray, tiny: Decimal) -> tuple[np.ndarray, np.ndarray]:
    """LU in place of a copy, with row order; a vanishing pivot becomes ``tiny``."""
    a = a.copy()
    order = np.arange(len(a))
    for k in range(len(a)):
        i = k + int(np.argmax(np.abs(a[k:, k])))
        a[[k, i]], order[[k, i]] = a[[i, k]], order[[i, k]]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        if k + 1 < len(a):
            a[k + 1 :, k] /= a[k, k]
            a[k + 1 :, k + 1 :] -= a[k + 1 :, k, None] * a[k, None, k + 1 :]
    return a, order


def _solve(lu: np.ndarray, order: np.ndarray, b: np.ndarray) -> np.ndarray:
    y = b[order]
    for k in range(1, len(y)):
        y[k] -= (lu[k, :k] * y[:k]).sum()
    for k in range(len(y) - 1, -1, -1):
        if k + 1 < len(y):
            y[k] -= (lu[k, k + 1 :] * y[k + 1 :]).sum()
        y[k] /= lu[k, k]
    return y


def _unit(y: np.ndarray) -> np.ndarray:
    y = y / max(abs(v) for v in y)
    return y / (y * y).sum().sqrt()


def null_space_vectors(matrix: np.ndarray, roots: list[tuple[int, int, int]]) -> tuple[np.ndarray, list[Decimal]]:
    """Unit vectors (columns, doubles) and eigenvalues of the enclosed roots."""
    with localcontext() as ctx:
        ctx.prec = DIGITS
        m = np.array([[Decimal(int(v)) for v in row] for row in matrix], object)
        size = max(abs(v) for v in m.ravel())
        tiny = size * Decimal(10) ** (5 - DIGITS)
        rng = np.random.default_rng(13)
        found, values = [], []
        last, space = None, []
        for low, high, shift in roots:
            root = Decimal(low + high) / Decimal(2 << shift)
            if last is None or last - root > last * Decimal(2) ** (4 - ROOT_BITS):
                space = []  # apart from the root before: its own null space
                lu, order = _factor(m - np.diag([root] * len(m)) * np.eye(len(m), dtype=int), tiny)
            last = root
            y = np.array([Decimal(int(v)) for v in rng.integers(1, 1 << 20, len(m))], object)
            for _ in range(8):
                for v in space:
                    y = y - (y * v).sum() * v
                new = _unit(_solve(lu, order, y))
                for v in space:
                    new = new - (new * v).sum() * v
                new = _unit(new)
                moved = min(abs(new - y).max(), abs(new + y).max())
                y = new
                if moved < Decimal(10) ** -30:
                    break
            space.append(y)
            found.append(y)
            values.append((y * (m * y).sum(axis=1)).sum())
        vectors = np.array([[float(v) for v in y] for y in found], np.float64).reshape(len(found), len(matrix)).T
        return np.ascontiguousarray(vectors), values


# ------------------------------------------------ fitting and applying


@dataclass(frozen=True)
class Whitening:
    """n distinct integer vectors with sums S; components (dimensions, k) with the square roots of
    their roots of M, the shares of the variance, and the error of the whitened covariance."""

    length: int
    scale: int
    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    lengths: np.ndarray
    explained: tuple[float, ...]
    identity_error: float | None


def _rows(column: pa.Array, length: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, length).astype(np.int64)


def _scatter(fit: DataFrame, length: int) -> tuple[int, list[int], np.ndarray]:
    """n, S and sum(x x') over the fit list, exactly."""
    upper = np.triu_indices(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(length, object), np.zeros(len(upper[0]), object)
        for batch in batches:
            x = _rows(batch.column("x"), length)
            top = int(np.abs(x).max(initial=0))
            # as many rows at once as doubles add up exactly
            step = max(1, (1 << 53) // max(top * top, 1))
            for low in range(0, len(x), step):
                part = x[low : low + step]
                exact = part.astype(np.float64) if top * top < 1 << 53 else part.astype(object)
                product = (exact.T @ exact)[upper]
                squares += product.astype(object) if product.dtype == object else product.astype(np.int64).astype(object)
            n += len(x)
            sums += x.sum(axis=0).astype(object)
        if not n:
            return
        values = [n, *sums.tolist(), *squares.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(values)), pa.int32()), pa.array([Decimal(int(v)) for v in values], _WHOLE)],
            ["place", "value"],
        )

    partial = fit.mapInArrow(run, "place int, value decimal(38,0)")
    rows = partial.groupBy("place").agg(F.sum("value").alias("value")).collect()
    totals = {r["place"]: int(r["value"]) for r in rows}
    squares = np.zeros((length, length), object)
    for place, (i, j) in enumerate(zip(*upper, strict=True), start=1 + length):
        squares[i, j] = squares[j, i] = totals[place]
    return totals[0], [totals[1 + i] for i in range(length)], squares


def _whitened(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n * x - S) as whole numbers, and the whitened values (rows, components)."""
    top = model.n * MAX_COMPONENT + max(map(abs, model.sums), default=0)
    if top < 1 << 62:
        centred = x * model.n - np.array(model.sums, np.int64)
    else:
        centred = x.astype(object) * model.n - np.array(model.sums, object)
    return centred, centred.astype(np.float64) @ model.components / model.lengths


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened fit list, less the identity."""
    k = model.components.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            _, w = _whitened(model, _rows(batch.column("x"), model.length))
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["place", "value"])

    rows = fit.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(k + k * k)
    for r in rows:
        total[r["place"]] = r["value"] / model.n
    mean, square = total[:k], total[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def _usable(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    x = F.transform("v", lambda c: F.floor(c.cast("double") * scale))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(finite("v"))
    return rows.select("id", x.alias("x"))


def fit_whitening(
    vectors: DataFrame, vector_col: str = "embedding", components: int = 4, scale: int = 256
) -> Whitening | None:
    """The whitening of all usable vectors; None without any, or where most have no components."""
    spark = vectors.sparkSession
    usable = _usable(vectors, vector_col, vector_col, scale).select("x")
    sizes = usable.groupBy(F.size("x").alias("length")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.array_max(F.transform("x", F.abs))).alias("top")
    )
    usual = sizes.orderBy(F.desc("rows"), "length").first()
    if usual is None or not usual["length"]:
        return None
    length = usual["length"]
    if usual["top"] is not None and usual["top"] > MAX_COMPONENT:
        raise ValueError(f"a component of {usual['top']} after scaling, beyond {MAX_COMPONENT}")
    whole = usable.where(F.size("x") == length).select(F.col("x").cast("array<int>").alias("x"))
    fit = materialize(whole.distinct(), "whitening-fit")
    n, sums, squares = _scatter(fit, length)
    matrix = squares * n - np.outer(np.array(sums, object), np.array(sums, object))
    trace = sum(matrix[i, i] for i in range(length))
    empty = Whitening(length, scale, n, tuple(sums), np.zeros((length, 0)), np.zeros(0), (), None)
    if not trace:
        release(fit)
        return empty
    common = math.gcd(*(abs(int(v)) for v in matrix.ravel()))
    reduced = matrix // common
    roots = largest_roots(characteristic_polynomial(spark, reduced), components)
    vectors_, values = null_space_vectors(reduced, roots)
    with localcontext() as ctx:
        ctx.prec = DIGITS
        lengths = np.array([float((v * common).sqrt()) for v in values])
        explained = tuple(float(v * common / Decimal(trace)) for v in values)
    model = Whitening(length, scale, n, tuple(sums), vectors_, lengths, explained, None)
    model = Whitening(length, scale, n, tuple(sums), vectors_, lengths, explained, _identity_error(fit, model))
    release(fit)
    return model


def whiten(
    vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(id, component, deviation decimal, whitened) of every usable row and component of the model."""
    kind = vectors.schema[id_col].dataType.simpleString()
    shape = f"_id {kind}, component int, deviation decimal(38,0), whitened double"
    k = model.components.shape[1] if model else 0
    if not k:
        out = vectors.sparkSession.createDataFrame([], shape)
        return out.withColumnRenamed("_id", id_col)
    rows = _usable(vectors, id_col, vector_col, model.scale)
    fits = F.size("x") == model.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("x")
            there = np.asarray(column.is_valid())
            x = _rows(column.drop_null(), model.length)
            centred, values = _whitened(model, x)
            top = max((abs(int(centred.max(initial=0))), abs(int(centred.min(initial=0)))))
            if centred.dtype != object and top * top * model.length < 1 << 63:
                deviation = pa.array((centred * centred).sum(axis=1)).cast(_WHOLE)
            else:
                exact = centred.astype(object)
                deviation = pa.array([Decimal(int(v)) for v in (exact * exact).sum(axis=1)], _WHOLE)
            # the place of each row among the usable ones, null for rows of another length
            place = pa.array(np.repeat(np.cumsum(there) - 1, k), mask=np.repeat(~there, k))
            flat = pa.array(values.ravel())
            at = pa.array(np.repeat(np.cumsum(there) - 1, k) * k + np.tile(np.arange(k), len(there)), mask=np.repeat(~there, k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(np.repeat(np.arange(len(there)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(there))),
                    deviation.take(place),
                    flat.take(at),
                ],
                ["_id", "component", "deviation", "whitened"],
            )

    kept = rows.select("id", F.when(fits, F.col("x")).alias("x"))
    return kept.mapInArrow(run, shape).withColumnRenamed("_id", id_col)
