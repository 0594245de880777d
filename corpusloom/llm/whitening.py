"""Whitening of embeddings from the exact characteristic polynomial of their integer scatter.

Entries c become whole numbers x = floor(SCALE * c) + SHIFT, so that everything up to the eigenvalues is exact:

1. *Scatter.* Tasks add up x and its products in 20-bit limbs (matrix products of doubles that hold whole numbers
   below 2**53); Spark adds the limbs. M = n * sum(x x') - S S' is n**2 times the covariance with divisor n.
2. *Polynomial.* Tasks bring M to Hessenberg form modulo primes below 2**31 and read off its characteristic
   polynomial; Chinese remaindering joins the residues. The number of primes follows from a bound on the coefficients
   (M is positive semidefinite, so they are at most those of (t + trace / d) ** d).
3. *Roots.* All roots are real, so Descartes' rule of signs is exact: the sign changes of the polynomial shifted to
   a point count the roots above it, with multiplicity. Bisection by these counts isolates the largest roots, sign
   changes of the polynomial refine those that are simple.
4. *Components.* Inverse iteration in the null space of M - root in decimals of ROOT_DIGITS digits; roots that agree to
   that precision share a space, in which an orthonormal basis is taken.

What passes through the driver depends on the dimension d of the vectors only: sums, polynomial and components. Vectors
themselves stay in the tasks, in three narrow scans (sums, measured covariance, result).

Defined cases: NULL vectors, vectors with a NULL, infinite or undefined entry or one of 2**61 or more after scaling, and vectors of
another length than the most frequent one (of several the longest; empty ones never count) are dropped. Repeated rows and ids count as rows
of their own. Components exist up to the dimension; those of an eigenvalue 0 have ``whitened`` NULL and do not count in the
identity error, and ``explained`` is 0 where all vectors are equal. ``deviation`` is NULL where it exceeds 2**63 - 1. An empty
table gives an empty table.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from math import comb, isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, SHIFT = 1024, 100_000
#: bits of a limb, and rows whose limb products a double can add up exactly (2 * 20 + 12 < 53)
LIMB, LIMB_ROWS = 20, 4096
#: bits of a part of a sum that Spark adds as a long
PART = 30
#: bits to which roots are refined, relative to the trace, and decimal digits of the inverse iteration
ROOT_BITS, ROOT_DIGITS = 256, 120


# whole numbers in tasks


def to_whole(batch: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of ``batch`` that count, their x as a matrix of longs)."""
    batch = batch.combine_chunks() if isinstance(batch, pa.ChunkedArray) else batch
    sizes = np.array([-1 if n is None else n for n in pc.list_value_length(batch).to_pylist()], np.int64)
    rows = np.flatnonzero(sizes == d)
    values = batch.take(pa.array(rows)).flatten().cast(pa.float64())
    flat = values.to_numpy(zero_copy_only=False).reshape(len(rows), d)  # NULL entries become NaN
    with np.errstate(invalid="ignore", over="ignore"):
        sound = (np.abs(flat) * SCALE < 2.0**61).all(axis=1) if d else np.zeros(len(rows), bool)
    return rows[sound], np.floor(flat[sound] * SCALE).astype(np.int64) + SHIFT


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Matrices of doubles l0, l1, ... with x = l0 + l1 * 2**LIMB + ...; the last one has the sign."""
    out = []
    while True:
        if (np.abs(x) < 1 << LIMB).all():
            return [*out, x.astype(np.float64)]
        out.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x = x >> LIMB


def gram(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact column sums and products x' x as Python numbers."""
    d = x.shape[1]
    total, product = np.zeros(d, object), np.zeros((d, d), object)
    for i in range(0, len(x), LIMB_ROWS):
        limbs = _limbs(x[i:i + LIMB_ROWS])
        for a, left in enumerate(limbs):
            total += left.sum(axis=0).astype(np.int64).astype(object) << (LIMB * a)
            for b, right in enumerate(limbs):
                product += (left.T @ right).astype(np.int64).astype(object) << (LIMB * (a + b))
    return total.tolist(), product.tolist()


def _parts(value: int) -> Iterator[tuple[int, int]]:
    """(place, part) with value = sum of part * 2**(PART * place); parts add up as longs over 2**33 tasks."""
    sign, value = (-1 if value < 0 else 1), abs(value)
    place = 0
    while value:
        yield place, sign * (value & ((1 << PART) - 1))
        value >>= PART
        place += 1


def _whole_vectors(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The column ``vector`` as ``v`` of non-NULL vectors, and the most frequent length (0 without any)."""
    vectors = df.select(F.col(vector).alias("v")).where("v IS NOT NULL")
    sizes = vectors.where(F.size("v") > 0).groupBy(F.size("v").alias("d")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return vectors, top["d"] if top else 0


def scatter(vectors: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, n * sum(x x') - S S') of a table with the one column ``v``, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, product = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            _, x = to_whole(batch.column(0), d)
            s, p = gram(x)
            n, total, product = n + len(x), total + np.array(s, object), product + np.array(p, object)
        # i = -2: number of rows, i = -1: sums, else products
        values = [(-2, 0, n), *[(-1, j, total[j]) for j in range(d)], *[(i, j, product[i, j]) for i in range(d) for j in range(i, d)]]
        rows = [(i, j, place, part) for i, j, value in values for place, part in _parts(int(value))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["i", "j", "place", "part"])

    summed = vectors.mapInArrow(run, "i long, j long, place long, part long").groupBy("i", "j", "place").agg(F.sum("part").alias("part"))
    found: dict[tuple[int, int], int] = {}
    for r in summed.collect():  # d * d entries of a few parts each
        found[r.i, r.j] = found.get((r.i, r.j), 0) + (r.part << (PART * r.place))
    n, sums = found.get((-2, 0), 0), [found.get((-1, j), 0) for j in range(d)]
    return n, sums, [[n * found.get((min(i, j), max(i, j)), 0) - sums[i] * sums[j] for j in range(d)] for i in range(d)]


# characteristic polynomial


def primes_below(limit: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``limit`` (at most 2**32), in falling order."""
    found: list[int] = []
    high = limit
    small = _sieve(isqrt(limit) + 1)
    while len(found) < count:
        low = max(2, high - (1 << 16))
        if high <= low:
            raise ValueError("too few primes")
        composite = np.zeros(high - low, bool)
        for p in small:
            composite[max(p * p, -(-low // p) * p) - low::p] = True
        found += (np.flatnonzero(~composite)[::-1] + low).tolist()
        high = low
    return found[:count]


def _sieve(limit: int) -> list[int]:
    prime = np.ones(limit + 1, bool)
    prime[:2] = False
    for p in range(2, isqrt(limit) + 1):
        if prime[p]:
            prime[p * p::p] = False
    return np.flatnonzero(prime).tolist()


def _inverses(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.array([pow(int(x), -1, int(q)) for x, q in zip(a, p)], np.int64)


def hessenberg_polynomials(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients, from the constant one up, of det(t - h) of each matrix in ``h`` modulo the prime in ``p``.

    All primes side by side; ``h`` is used up. Products of residues below 2**31 fit a long.
    """
    count, d, _ = h.shape
    q = p[:, None]
    each = np.arange(count)
    for k in range(1, d - 1):
        # bring a non-zero entry of column k - 1 to row k, and eliminate the entries below it
        below = h[:, k:, k - 1] != 0
        pivot = np.where(below.any(axis=1), below.argmax(axis=1) + k, k)
        rows = h[each, pivot].copy()
        h[each, pivot], h[:, k] = h[:, k].copy(), rows
        columns = h[each, :, pivot].copy()
        h[each, :, pivot], h[:, :, k] = h[:, :, k].copy(), columns
        some = np.flatnonzero(h[:, k, k - 1])
        inverse = np.zeros(count, np.int64)
        inverse[some] = _inverses(h[some, k, k - 1], p[some])
        factor = h[:, k + 1:, k - 1] * inverse[:, None] % q
        h[:, k + 1:] = (h[:, k + 1:] - factor[:, :, None] * h[:, None, k] % q[:, :, None]) % q[:, :, None]
        for i in range(d - k - 1):  # the inverse operation on columns; sums of products would overflow
            h[:, :, k] = (h[:, :, k] + h[:, :, k + 1 + i] * factor[:, i, None]) % q
    polynomial = np.zeros((d + 1, count, d + 1), np.int64)  # of the leading blocks of size 0, 1, ...
    polynomial[0, :, 0] = 1
    for m in range(1, d + 1):
        polynomial[m, :, 1:] = polynomial[m - 1, :, :-1]
        product = np.ones(count, np.int64)
        for i in range(m, 0, -1):
            weight = h[:, i - 1, m - 1] * product % p
            polynomial[m] = (polynomial[m] - weight[:, None] * polynomial[i - 1]) % q
            if i > 1:
                product = product * h[:, i - 1, i - 2] % p
    return polynomial[d]


def remainders(values: list[list[int]], primes: list[int], spread: DataFrame | None = None) -> list[list[int]]:
    """Characteristic polynomials of a matrix modulo each prime; ``spread`` deals (k) of primes[k] over tasks."""
    d = len(values)

    def some(ks: list[int]) -> np.ndarray:
        p = np.array([primes[k] for k in ks], np.int64)
        h = np.array([[[x % q for x in row] for row in values] for q in p.tolist()], np.int64).reshape(len(ks), d, d)
        return hessenberg_polynomials(h, p)

    if spread is None:
        return some(list(range(len(primes)))).tolist()
    step = max(1, (1 << 21) // (d * d + 1))  # primes side by side, bounded in bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ks = batch.column(0).to_pylist()
            for i in range(0, len(ks), step):
                part = ks[i:i + step]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int64()), pa.array(some(part).tolist(), pa.list_(pa.int64()))], names=["k", "residues"])

    rows = spread.mapInArrow(run, "k long, residues array<long>").collect()
    found = {r.k: r.residues for r in rows}
    return [found[k] for k in range(len(primes))]


def chinese_remainder(residues: list[list[int]], primes: list[int]) -> list[int]:
    """The whole numbers of least absolute value with these residues (one list per prime)."""
    value, modulus = [0] * len(residues[0]), 1
    for found, p in zip(residues, primes):
        inverse = pow(modulus, -1, p)
        value = [v + modulus * ((r - v) * inverse % p) for v, r in zip(value, found)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in value]


def characteristic_polynomial(values: list[list[int]], spark=None) -> list[int]:
    """Coefficients of det(t - M), constant one first, of a positive semidefinite matrix of whole numbers.

    With ``spark`` the primes are dealt over tasks.
    """
    d, trace = len(values), sum(values[i][i] for i in range(len(values)))
    bound = max(comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    primes = primes_below(1 << 31, (2 * bound).bit_length() // 30 + 2)
    spread = None
    if spark is not None:
        tasks = min(len(primes), spark.sparkContext.defaultParallelism)
        spread = spark.range(0, len(primes), 1, tasks).select("id")
    return chinese_remainder(remainders(values, primes, spread), primes)


# roots


def roots_above(polynomial: list[int], at: Fraction) -> int:
    """Roots above ``at``, with multiplicity, of a polynomial that has real roots only."""
    d = len(polynomial) - 1
    a, b = at.numerator, at.denominator
    # coefficients of b**d * p(t / b), then the shift by a
    c = [v * b ** (d - i) for i, v in enumerate(polynomial)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(polynomial: list[int], at: Fraction) -> int:
    d, a, b = len(polynomial) - 1, at.numerator, at.denominator
    value, scale = 0, 1
    for c in reversed(polynomial):
        value = value * a + c * scale
        scale *= b
    return (value > 0) - (value < 0)


def largest_roots(polynomial: list[int], k: int, trace: int) -> list[tuple[Fraction, int]]:
    """(root, multiplicity) of the largest roots in falling order, until their multiplicities reach ``k``.

    For polynomials with roots in [0, trace] only. Roots are refined to trace / 2**ROOT_BITS; roots closer than that count
    as one. A root 0 is given as exactly 0.
    """
    zeros = next(i for i, c in enumerate(polynomial) if c)
    rest = polynomial[zeros:]
    positive = len(rest) - 1
    top = 1 << trace.bit_length()  # bisection points stay binary fractions
    width = Fraction(top, 1 << ROOT_BITS)
    found: list[tuple[Fraction, int]] = []
    # intervals (low, high] with the number of roots above low and above high, largest first on top of the stack
    stack = [(Fraction(0), Fraction(top), positive, 0)] if positive else []
    while stack and sum(m for _, m in found) < k:
        low, high, above_low, above_high = stack.pop()
        count = above_low - above_high
        if count == 0:
            continue
        if count == 1:
            found.append((_refine(rest, low, high, width), 1))
            continue
        if high - low <= width:
            found.append(((low + high) / 2, count))
            continue
        middle = (low + high) / 2
        above = roots_above(rest, middle)
        stack.append((low, middle, above_low, above))
        stack.append((middle, high, above, above_high))
    if sum(m for _, m in found) < k and zeros:
        found.append((Fraction(0), zeros))
    return found


def _refine(polynomial: list[int], low: Fraction, high: Fraction, width: Fraction) -> Fraction:
    """The only root in (low, high], to ``width``."""
    above = _sign(polynomial, high)
    if above == 0:
        return high
    while high - low > width:
        middle = (low + high) / 2
        sign = _sign(polynomial, middle)
        if sign == 0:
            return middle
        if sign == above:
            high = middle
        else:
            low = middle
    return (low + high) / 2


# components


def _factor(rows: list[list[Decimal]], least: Decimal) -> list[int]:
    """LU factors with row exchanges, in place; pivots below ``least`` become ``least``, as the matrix is all but singular."""
    d, order = len(rows), list(range(len(rows)))
    for i in range(d):
        pivot = max(range(i, d), key=lambda r: abs(rows[r][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        order[i], order[pivot] = order[pivot], order[i]
        if abs(rows[i][i]) < least:
            rows[i][i] = least
        tail = rows[i][i + 1:]
        for j in range(i + 1, d):
            factor = rows[j][i] = rows[j][i] / rows[i][i]
            if factor:
                rows[j][i + 1:] = [a - factor * b for a, b in zip(rows[j][i + 1:], tail)]
    return order


def _solve(rows: list[list[Decimal]], order: list[int], vector: list[Decimal]) -> list[Decimal]:
    """Solve with the factors of ``_factor``."""
    x = [vector[i] for i in order]
    for i in range(len(x)):
        x[i] -= sum((rows[i][j] * x[j] for j in range(i)), Decimal(0))
    for i in reversed(range(len(x))):
        x[i] = (x[i] - sum((rows[i][j] * x[j] for j in range(i + 1, len(x))), Decimal(0))) / rows[i][i]
    return x


def _dot(x: list[Decimal], y: list[Decimal]) -> Decimal:
    return sum((a * b for a, b in zip(x, y)), Decimal(0))


def null_space(values: list[list[int]], root: Fraction, m: int) -> list[list[float]]:
    """``m`` orthonormal vectors v with (M - root) v = 0, by inverse iteration; the largest entry of each is positive."""
    d = len(values)
    with decimal.localcontext(prec=ROOT_DIGITS, Emin=-999_999, Emax=999_999):
        shift = Decimal(root.numerator) / Decimal(root.denominator)
        exact = [[Decimal(v) for v in row] for row in values]
        size = max(abs(v) for row in exact for v in row)
        rows = [[v - shift if i == j else v for j, v in enumerate(row)] for i, row in enumerate(exact)]
        order = _factor(rows, size.scaleb(10 - ROOT_DIGITS))
        basis: list[list[Decimal]] = []
        for start in range(d):
            if len(basis) == m:
                break
            x = [Decimal(1) if i == start else 1 / Decimal(i + start + 2) for i in range(d)]
            for _ in range(3):
                x = _solve(rows, order, x)
                for b in basis * 2:  # twice, as digits cancel
                    along = _dot(x, b)
                    x = [p - along * q for p, q in zip(x, b)]
                norm = _dot(x, x).sqrt()
                x = [v / norm for v in x]
            if max(abs(_dot(row, x) - shift * v) for row, v in zip(exact, x)) < size.scaleb(-30):
                basis.append(x)
        return [[float(v) if max(x, key=abs) > 0 else -float(v) for v in x] for x in basis]


# the operator


class Whitener:
    """What a task needs to whiten vectors: sizes of the fit and the components as columns."""

    def __init__(self, n: int, sums: list[int], components: list[list[float]], eigenvalues: list[Fraction]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.fraction = np.array([float(Fraction(s % n, n)) for s in sums])
        self.matrix = np.array(components, float).reshape(len(components), len(sums)).T / np.sqrt(np.array([float(e) for e in eigenvalues]))

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, unrounded, on the components, each over the root of its eigenvalue."""
        return ((x - self.whole).astype(np.float64) - self.fraction) @ self.matrix

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - S)**2; None beyond a long."""
        rest = np.array([s % self.n for s in self.sums], object)
        from_mean = x - self.whole
        largest = (int(np.abs(from_mean).max(initial=0)) + 1) * self.n
        if largest**2 * x.shape[1] < 1 << 63:
            u = from_mean * self.n - rest.astype(np.int64)
            return (u * u).sum(axis=1).tolist()
        u = from_mean.astype(object) * self.n - rest
        return [v if v < 1 << 63 else None for v in (u * u).sum(axis=1).tolist()]


def _identity_error(vectors: DataFrame, d: int, fit: Whitener) -> float | None:
    """Largest absolute entry of the covariance of the whitened vectors, as measured, minus the identity."""
    k = fit.matrix.shape[1]
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = fit.whiten(to_whole(batch.column(0), d)[1])
            total += w.sum(axis=0)
            product += w.T @ w
        i, j = np.indices((k, k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i.ravel(), np.full(k, -1))), pa.array(np.append(j.ravel(), np.arange(k))), pa.array(np.append(product.ravel(), total))],
            names=["i", "j", "part"])

    rows = vectors.mapInArrow(run, "i long, j long, part double").groupBy("i", "j").agg(F.sum("part").alias("part")).collect()
    found = {(r.i, r.j): r.part / fit.n for r in rows}
    return max(abs(found[i, j] - found[-1, i] * found[-1, j] - (i == j)) for i in range(k) for j in range(k))


def whitened(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 8) -> DataFrame:
    """Per vector that counts and component up to ``k``: id, component, n, deviation, whitened, explained, identity_error.

    The fit list is all vectors that count. Runs jobs while it is built, whose results depend on the dimension only.
    """
    schema = T.StructType([
        T.StructField(vec_id, df.schema[vec_id].dataType), T.StructField("component", T.IntegerType(), False), T.StructField("n", T.LongType(), False),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType(), False),
        T.StructField("identity_error", T.DoubleType())])
    vectors, d = _whole_vectors(df, vector)
    n, sums, values = scatter(vectors, d) if d else (0, [], [])
    if not n:
        return df.sparkSession.createDataFrame([], schema)
    trace = sum(values[i][i] for i in range(d))
    k = min(k, d)
    roots = largest_roots(characteristic_polynomial(values, df.sparkSession), k, trace)
    found = [(root, v) for root, m in roots if root for v in null_space(values, root, m)][:k]
    fit = Whitener(n, sums, [v for _, v in found], [root / n**2 for root, _ in found])
    explained = [float(root / trace) for root, _ in found] + [0.0] * (k - len(found))
    error = _identity_error(vectors, d, fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = to_whole(batch.column(1), d)
            w = np.full((len(x), k), np.nan)
            w[:, :len(found)] = fit.whiten(x)
            lost = np.tile(np.arange(k) >= len(found), len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(x) * k, n)), pa.array([v for v in fit.deviations(x) for _ in range(k)], pa.int64()),
                 pa.array(w.ravel(), mask=lost), pa.array(np.tile(explained, len(x))), pa.array([error] * (len(x) * k), pa.float64())],
                names=schema.fieldNames())

    return df.select(F.col(vec_id).alias("i"), F.col(vector).alias("v")).where("v IS NOT NULL").mapInArrow(run, schema)
