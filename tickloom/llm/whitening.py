"""Whitening of vectors along principal components, from an exact characteristic polynomial.

Vectors are rounded to whole numbers x. With n distinct x and their sums S, the matrix ``M = n sum(x x') - S S'`` is
n^2 times their covariance and has whole entries, so its characteristic polynomial has whole coefficients. They are
found without any rounding: modulo many primes, each a row of a Spark job, the matrix is brought to Hessenberg form, whose
polynomial follows from a recurrence; Chinese remainders give the coefficients, in number as many primes as their
bound needs. All roots are real, so the changes of sign after moving the origin count the roots above it, and
bisection isolates the largest roots to as many bits as asked. Inverse iteration in decimals of that precision turns
to the null space of ``M - root``: the components.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.common import col
from tickloom.session import written

SCALE, COMPONENTS = 256, 4
# Bits of a root beyond its leading one; roots that agree in so many count as one of higher multiplicity.
ROOT_BITS = 128
# Different lengths of vectors that are fitted in one call, and the entries of one matrix.
MOST_LENGTHS, MOST_ENTRIES = 64, 1 << 22
# Limbs of exact products: so many bits, so many rows at a time stay below 2^53.
_LIMB, _ROWS = 20, 4096
_HIGH = 60  # where a whole number is split to be added up as decimals
_LONG = 1 << 63


# --- whole vectors -----------------------------------------------------------------------------


def _pack(x: np.ndarray) -> list[bytes]:
    """Rows of whole numbers as bytes: the width of the narrowest integers that hold a row, then these."""
    low, high = x.min(axis=1), x.max(axis=1)
    width = np.full(len(x), 8)
    for w in (4, 2, 1):
        width[(low >= -(1 << 8 * w - 1)) & (high < 1 << 8 * w - 1)] = w
    out: list[bytes] = [b""] * len(x)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        data = x[rows].astype(f"<i{w}").tobytes()
        step = w * x.shape[1]
        for k, r in enumerate(rows.tolist()):
            out[r] = bytes([w]) + data[k * step : (k + 1) * step]
    return out


def _unpack(packed: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(packed), dim), np.int64)
    widths = np.array([p[0] for p in packed])
    for w in np.unique(widths):
        rows = np.flatnonzero(widths == w)
        data = b"".join(packed[r][1:] for r in rows)
        out[rows] = np.frombuffer(data, f"<i{w}").reshape(len(rows), dim)
    return out


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """The rows whose vector is sound: vec_id, dim, and ``floor(scale * c)`` of every entry, packed.

    Entries beyond the range of a long take its nearest end.
    """
    given = vectors.select(col(vectors, id_col).alias("vec_id"), col(vectors, vector_col).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = given.filter(F.col("v").isNotNull() & (F.size("v") > 0) & sound).withColumn("dim", F.size("v"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                some = batch.filter(pa.array(dims == dim))
                flat = np.floor(scale * some.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64))
                # the ends of the range are not doubles, so they are put in as whole numbers
                x = np.where(np.abs(flat) < 2.0**63, flat, 0).astype(np.int64)
                x[flat >= 2.0**63], x[flat < -(2.0**63)] = _LONG - 1, -_LONG
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(2), pa.array(_pack(x.reshape(-1, dim)), pa.binary())], names=["vec_id", "dim", "x"])

    kind = given.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, dim int, x binary")


# --- exact sums --------------------------------------------------------------------------------


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """``x = sum(limb * 2^(20 k))``, limbs as doubles, the last signed."""
    out, bits = [], 1 + max(int(x.max(initial=0)).bit_length(), int(x.min(initial=0)).bit_length())
    while bits > _LIMB:
        out.append((x & ((1 << _LIMB) - 1)).astype(np.float64))
        x, bits = x >> _LIMB, bits - _LIMB
    return [*out, x.astype(np.float64)]


def exact_products(x: np.ndarray) -> tuple[list[int], list[int]]:
    """Sums of all columns, and of the products of columns i and j <= i, as whole numbers of any size."""
    dim = x.shape[1]
    low = np.tril_indices(dim)
    sums, products = np.zeros(dim, object), np.zeros(len(low[0]), object)
    for at in range(0, len(x), _ROWS):
        limbs = _limbs(x[at : at + _ROWS])
        for a, left in enumerate(limbs):
            sums += left.sum(axis=0).astype(np.int64).astype(object) * (1 << _LIMB * a)
            for b, right in enumerate(limbs[: a + 1]):
                part = (left.T @ right).astype(np.int64)
                whole = part if a == b else part + part.T
                products += whole[low].astype(object) * (1 << _LIMB * (a + b))
    return sums.tolist(), products.tolist()


@dataclass
class Scatter:
    """The number n of distinct vectors, their sums S, and ``M = n sum(x x') - S S'``."""

    n: int
    sums: list[int]
    matrix: list[list[int]]


def scatter(distinct: DataFrame) -> dict[int, Scatter]:
    """The exact scatter of the distinct vectors of each length.

    A task adds up its own vectors and gives a row for each entry, in two parts that add up as decimals. What reaches
    the driver is one matrix of each length, whatever the number of rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[list[int], list[int], int]] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                x = _unpack(batch.column(1).filter(pa.array(dims == dim)).to_pylist(), dim)
                s, p = exact_products(x)
                n = len(x)
                if dim in totals:
                    so, po, no = totals[dim]
                    s, p, n = [a + b for a, b in zip(s, so)], [a + b for a, b in zip(p, po)], n + no
                totals[dim] = (s, p, n)
        for dim, (s, p, n) in totals.items():
            entries = [*p, *s, n]
            split = [(Decimal(v & ((1 << _HIGH) - 1)), Decimal(v >> _HIGH)) for v in entries]
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * len(entries), pa.int32()), pa.array(range(len(entries)), pa.int64()),
                 pa.array([a for a, _ in split], pa.decimal128(28, 0)), pa.array([b for _, b in split], pa.decimal128(28, 0))],
                names=["dim", "entry", "low", "high"])

    parts = distinct.mapInArrow(run, "dim int, entry long, low decimal(28,0), high decimal(28,0)")
    added = parts.groupBy("dim", "entry").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).collect()
    found: dict[int, Scatter] = {}
    for dim in sorted({r.dim for r in added}):
        value = {r.entry: int(r.low) + (int(r.high) << _HIGH) for r in added if r.dim == dim}
        pairs = dim * (dim + 1) // 2
        sums, n = [value[pairs + k] for k in range(dim)], value[pairs + dim]
        low = [[n * value[i * (i + 1) // 2 + j] - sums[i] * sums[j] for j in range(i + 1)] for i in range(dim)]
        found[dim] = Scatter(n, sums, [[low[max(i, j)][min(i, j)] for j in range(dim)] for i in range(dim)])
    return found


# --- the characteristic polynomial -------------------------------------------------------------


def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top``, found by division through small primes."""
    limit = math.isqrt(top) + 1
    sieve = np.ones(limit + 1, bool)
    sieve[:2] = False
    for p in range(2, math.isqrt(limit) + 1):
        if sieve[p]:
            sieve[p * p :: p] = False
    small, found, high = np.flatnonzero(sieve), [], top
    while len(found) < count:
        low = high - (1 << 16)
        block = np.ones(1 << 16, bool)
        for p in small.tolist():
            block[-low % p :: p] = False
        found += (low + np.flatnonzero(block)[::-1]).tolist()
        high = low
    return found[:count]


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """The coefficients of ``det(t - matrix)`` modulo a prime below 2^31, from that of t^0 on."""
    h, d = matrix.copy() % p, len(matrix)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        r = k + 1 + below[0]
        if r != k + 1:  # a similar matrix: rows and columns change places alike
            h[[r, k + 1]] = h[[k + 1, r]]
            h[:, [r, k + 1]] = h[:, [k + 1, r]]
        f = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - f[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + _dot(h[:, k + 2 :], f, p)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):
        factors, run = [int(h[k, k])], 1
        for i in range(k - 1, -1, -1):
            run = run * int(h[i + 1, i]) % p
            factors.append(run * int(h[i, k]) % p)
        polys[k + 1, 1:] = polys[k, :-1]
        polys[k + 1] = (polys[k + 1] - _dot(polys[: k + 1].T, np.array(factors[::-1], np.int64), p)) % p
    return polys[d]


def _dot(rows: np.ndarray, f: np.ndarray, p: int) -> np.ndarray:
    """``rows @ f`` modulo a prime below 2^31; factors by halves, so that up to 2^16 products stay within a long."""
    return ((rows @ (f >> 16) % p << 16) + rows @ (f & 0xFFFF)) % p


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The whole coefficients of ``det(t - matrix)``, from that of t^0 on, for a symmetric matrix of whole numbers.

    The coefficient of t^(d-k) is a sum of minors of order k, so by Hadamard's bound all are at most
    ``prod(1 + |row|)``. Primes are rows of a job: what a task holds is the matrix modulo one of them.
    """
    d = len(matrix)
    bound = 1
    for row in matrix:
        bound *= 2 + math.isqrt(sum(v * v for v in row))
    top = 1 << 31
    count = (2 * bound).bit_length() // 30 + 1
    primes = primes_below(top, count)
    # the matrix in parts of 30 bits: any prime's remainders follow from them
    size = max(1, max(abs(v) for row in matrix for v in row).bit_length())
    signs = np.array([[-1 if v < 0 else 1 for v in row] for row in matrix], np.int64)
    parts = np.array([[[abs(v) >> s & ((1 << 30) - 1) for v in row] for row in matrix] for s in range(0, size, 30)], np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                m = np.zeros_like(signs)
                for part in parts[::-1]:
                    m = (m * (1 << 30) + part) % p
                poly = polynomial_modulo(m * signs, p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int64()), pa.array([poly.tolist()], pa.list_(pa.int64()))], names=["p", "poly"])

    job = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(count, 4 * spark.sparkContext.defaultParallelism))
    found = {r.p: r.poly for r in job.mapInArrow(run, "p long, poly array<long>").collect()}
    values, modulus = [0] * (d + 1), 1
    for p in primes:
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((c - v) * inverse % p) for v, c in zip(values, found[p])]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


# --- roots -------------------------------------------------------------------------------------


def roots_above(poly: list[int], c: int) -> int:
    """How many roots of a polynomial with only real roots are above ``c``, multiple ones counted so often.

    By Descartes' rule, exact for such polynomials: the changes of sign after moving ``c`` to 0.
    """
    shifted = list(poly)
    for i in range(len(poly) - 1):
        for j in range(len(poly) - 2, i - 1, -1):
            shifted[j] += c * shifted[j + 1]
    signs = [v > 0 for v in shifted if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(poly: list[int], c: int) -> int:
    total = 0
    for v in reversed(poly):
        total = total * c + v
    return total


def largest_roots(poly: list[int], count: int, bits: int = ROOT_BITS) -> tuple[list[int], int]:
    """The ``count`` largest of the real roots, none below 0, times 2^s, rounded down, and s; roots of 0 are 0.

    An interval is halved by counts of roots until it holds one, then by the sign of the polynomial, until
    ``bits`` of the root are known. Equal or closer roots come out equal.
    """
    d = len(poly) - 1
    # no root is above the sum of all, which a coefficient tells
    top = max(1, -poly[d - 1]) if d else 1
    positive = roots_above(poly, 0)
    found, scaled_by = [], {}
    for k in range(1, min(count, d) + 1):
        if k > positive:
            found.append((0, 0))
            continue
        s, low, high = 0, 0, top
        scaled_by[0] = poly
        # low < root <= high, in units of 2^-s
        while True:
            if high - low <= 1:
                if high.bit_length() > bits or s > 64 * bits:
                    break
                more = max(1, bits + 1 - high.bit_length())
                s, low, high = s + more, low << more, high << more
                if s not in scaled_by:
                    scaled_by[s] = [v << s * (d - j) for j, v in enumerate(poly)]
            q = scaled_by[s]
            single = roots_above(q, low) - roots_above(q, high) == 1
            if single and _value(q, low) and _value(q, high):
                below = _value(q, low) > 0
                while high - low > 1:
                    middle = (low + high) // 2
                    v = _value(q, middle)
                    if v and (v > 0) == below:
                        low = middle
                    else:
                        high = middle
            elif high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if roots_above(q, middle) >= k else (low, middle)
        found.append((high, s))
    s = max((s for _, s in found), default=0)
    return [v << (s - t) for v, t in found], s


# --- components --------------------------------------------------------------------------------


def component_vectors(matrix: list[list[int]], roots: list[int], s: int, digits: int = 80) -> np.ndarray:
    """Unit eigenvectors of the largest roots, in the rows of a matrix; the largest entry of each is above 0.

    By inverse iteration: a triangular form of ``matrix - root``, solved again and again. Those of equal or close
    roots are kept at right angles to each other.
    """
    d = len(matrix)
    scale = max(1, max(abs(v) for row in matrix for v in row))
    out: list[list[Decimal]] = []
    with decimal.localcontext() as context:
        context.prec, context.Emax, context.Emin = digits, decimal.MAX_EMAX, decimal.MIN_EMIN
        size = Decimal(scale)
        tiny = Decimal(10) ** -(digits - 10)
        base = [[Decimal(v) / size for v in row] for row in matrix]
        for k, root in enumerate(roots):
            mu = Decimal(root) / (Decimal(1 << s) * size)
            a = [[v - mu if i == j else v for j, v in enumerate(row)] for i, row in enumerate(base)]
            swaps = []
            for c in range(d):
                r = max(range(c, d), key=lambda i: abs(a[i][c]))
                swaps.append(r)
                a[c], a[r] = a[r], a[c]
                if abs(a[c][c]) < tiny:  # the root itself, to the last digit
                    a[c][c] = tiny
                top = a[c]
                for i in range(c + 1, d):
                    if a[i][c]:
                        f = a[i][c] / top[c]
                        row = a[i]
                        for j in range(c + 1, d):
                            row[j] -= f * top[j]
                        row[c] = f  # the factors stand below the diagonal
            # those of roots that are no more than rounding apart
            near = [out[i] for i in range(k) if abs(roots[i] - root) <= max(roots[0] >> 60, 1)]
            x = [Decimal(1 + (i * (k + 1)) % 7) / (i + k + 1) for i in range(d)]
            for _ in range(4):
                for c in range(d):
                    x[c], x[swaps[c]] = x[swaps[c]], x[c]
                    if x[c]:
                        for i in range(c + 1, d):
                            x[i] -= a[i][c] * x[c]
                for c in range(d - 1, -1, -1):
                    x[c] = (x[c] - sum((a[c][j] * x[j] for j in range(c + 1, d)), Decimal(0))) / a[c][c]
                most = max(abs(v) for v in x)
                x = [v / most for v in x]
                for other in near:
                    dot = sum((u * v for u, v in zip(other, x)), Decimal(0))
                    x = [v - dot * u for u, v in zip(other, x)]
                length = sum((v * v for v in x), Decimal(0)).sqrt()
                x = [v / length for v in x]
            if max(x, key=abs) < 0:
                x = [-v for v in x]
            out.append(x)
        return np.array([[float(v) for v in x] for x in out]).reshape(len(roots), d)


@dataclass
class Whitening:
    """What a fit has found for vectors of one length."""

    n: int
    sums: list[int]
    components: np.ndarray  # a row each
    eigenvalues: list[float]  # of the covariance
    explained: list[float]

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray | list]:
        """``x - S/n`` in doubles, and the sum of squares of ``n x - S`` of each row, exact."""
        most = self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, self.sums))
        if x.shape[1] * most * most < _LONG:
            moved = self.n * x - np.array(self.sums, np.int64)
            return moved / self.n, (moved * moved).sum(axis=1)
        moved = self.n * x.astype(object) - np.array(self.sums, object)
        squares = (moved * moved).sum(axis=1).tolist()
        return (moved / self.n).astype(np.float64), [v if v < _LONG else None for v in squares]

    def project(self, centred: np.ndarray) -> np.ndarray:
        """Along the components, in units of their deviation; NaN along one that has none."""
        roots = np.sqrt(np.array(self.eigenvalues))
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(roots > 0, centred @ self.components.T / roots, np.nan)


def fit_scatter(spark: SparkSession, found: Scatter, components: int = COMPONENTS) -> Whitening:
    """The largest components of a scatter matrix."""
    poly = characteristic_polynomial(spark, found.matrix)
    roots, s = largest_roots(poly, components)
    vectors = component_vectors(found.matrix, roots, s)
    trace, unit = sum(row[i] for i, row in enumerate(found.matrix)), found.n * found.n
    return Whitening(
        found.n, found.sums, vectors, [_ratio(r, unit << s) for r in roots],
        [_ratio(r, trace << s) if trace else 0.0 for r in roots])


def _ratio(a: int, b: int) -> float:
    """The double nearest to a quotient of whole numbers of any size."""
    return a / b if b else 0.0


def whitened(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
) -> DataFrame:
    """A row per sound vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Vectors that are null, empty or hold a null, infinite or NaN are dropped. The fit is over the distinct
    ``x = floor(scale * c)``, so a vector that fills a third of the rows counts once: n of them with sums S. Components are
    eigenvectors of their covariance by falling eigenvalue e, as many as the vectors are long at most. ``deviation`` is the
    sum of ``(n x - S)^2``, exact, null where it exceeds a long; ``whitened`` the projection of ``x - S/n`` over
    ``sqrt(e)``, null where e is 0; ``explained`` e over the trace, 0 where that is 0. ``identity_error`` is the largest entry
    by which the covariance of the whitened fit list differs from the identity, over components with e above 0, null without
    any. Components of equal eigenvalues are any at right angles. Vectors of different lengths are fitted apart (at most
    ``MOST_LENGTHS`` lengths, else ValueError). Repeated rows each get theirs; null ids stay; an empty table gives no rows;
    other columns are not read.
    """
    spark = vectors.sparkSession
    rows = written(whole_vectors(vectors, id_col, vector_col, scale), "whole-vectors")
    distinct = written(rows.select("dim", "x").distinct(), "distinct-vectors")
    lengths = [r.dim for r in distinct.select("dim").distinct().limit(MOST_LENGTHS + 1).collect()]
    if len(lengths) > MOST_LENGTHS or any(d * d > MOST_ENTRIES for d in lengths):
        raise ValueError(f"vectors of more than {MOST_LENGTHS} lengths, or longer than {math.isqrt(MOST_ENTRIES)}")
    fits = {dim: fit_scatter(spark, s, components) for dim, s in scatter(distinct).items()}
    shared = spark.sparkContext.broadcast(fits)  # a few rows of each length, which is bounded
    errors = _identity_errors(distinct, shared)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                some, fit = batch.filter(pa.array(dims == dim)), shared.value[dim]
                centred, deviation = fit.centred(_unpack(some.column(2).to_pylist(), dim))
                k, n = len(fit.eigenvalues), some.num_rows
                w = fit.project(centred).reshape(-1)
                each = pa.array(np.repeat(np.arange(n), k))
                yield pa.RecordBatch.from_arrays([
                    some.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                    pa.array(np.full(n * k, fit.n), pa.int64()), pa.array(deviation, pa.int64()).take(each),
                    pa.array(w, pa.float64(), mask=np.isnan(w)), pa.array(np.tile(fit.explained, n), pa.float64()),
                    pa.array([errors.get(dim)] * (n * k), pa.float64()),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def _identity_errors(distinct: DataFrame, shared) -> dict[int, float]:
    """By length of vector, how far the covariance of the whitened distinct vectors is from the identity."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                fit = shared.value[dim]
                w = fit.project(fit.centred(_unpack(batch.column(1).filter(pa.array(dims == dim)).to_pylist(), dim))[0])
                w = w[:, np.array(fit.eigenvalues) > 0]
                totals[dim] = totals.get(dim, 0) + (w.T @ w).reshape(-1)
        for dim, sums in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * len(sums), pa.int32()), pa.array(range(len(sums)), pa.int32()), pa.array(sums, pa.float64())],
                names=["dim", "entry", "total"])

    parts = distinct.mapInArrow(run, "dim int, entry int, total double")
    found: dict[int, float] = {}
    for r in parts.groupBy("dim", "entry").agg(F.sum("total").alias("total")).collect():
        fit = shared.value[r.dim]
        k = sum(e > 0 for e in fit.eigenvalues)
        found[r.dim] = max(found.get(r.dim, 0.0), abs(r.total / fit.n - (r.entry % (k + 1) == 0)))
    return found
