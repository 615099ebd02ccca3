"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Vectors become whole numbers, so n times their scatter about the mean is a matrix M of whole
numbers, n * n times the covariance, summed without rounding. Its characteristic polynomial is
found modulo many primes (reduction to Hessenberg form, a Spark task for some primes each) and
put together by Chinese remainders. All roots of a symmetric matrix are real, so the number of
roots above any point is the number of sign changes of the shifted polynomial, exactly: that
separates the largest roots, and signs of the polynomial narrow them to 160 bits. Components are
null vectors of M - root, by inverse iteration in 320-bit fixed point, a task for each root.

The driver holds M and the polynomial: of the order of the square of a vector's length, whatever
the number of rows. Rows are only read: once for the sums, once for the check, once for the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import comb, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 64
SHIFT = 1_000_000
# An entry beyond this makes no long number; such vectors go as those without finite entries do.
LARGEST = 2.0**61
ROOT_BITS = 160
# Roots that agree in so many leading bits count as one of higher multiplicity.
SAME_BITS = 80
FIXED_BITS = 320
ROWS = 4096

SUMS = "dims int, i int, j int, total decimal(38,0)"
POLYNOMIALS = "p long, coefficients array<long>"
COMPONENTS = "number int, vectors array<array<double>>"
PRODUCTS = "dims int, i int, j int, total double"
WHITENED = "component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Fit:
    """What whitening needs of the vectors of one length."""

    n: int
    sums: list[int]
    roots: list[Fraction]
    trace: int
    components: np.ndarray

    def directions(self) -> np.ndarray:
        """Columns by which n * x - S is multiplied; one per component."""
        lengths = [_float_sqrt(root) for root in self.roots]
        return self.components.T / np.array(lengths) if lengths else np.empty((len(self.sums), 0))


def _float_sqrt(value: Fraction) -> float:
    bits = max(0, 120 - (value.numerator.bit_length() - value.denominator.bit_length()))
    bits += bits % 2
    return isqrt((value.numerator << bits) // value.denominator) / 2.0 ** (bits // 2)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector of doubles) of the rows whose entries are all there and finite."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c * SCALE) < LARGEST, F.lit(False)))
    return df.select(F.col(id_col).alias("id"), vector.alias("vector")).where(
        fine & (F.size("vector") > 0)
    )


def numbers(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and floor(64 * c) of the vectors of each length, some rows at a time."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for dims in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == dims)
        for a in range(0, len(places), ROWS):
            some = places[a : a + ROWS]
            begin = ends[some] - dims
            yield some, np.floor(flat[begin[:, None] + np.arange(dims)] * SCALE).astype(np.int64)


def scatter(y: np.ndarray) -> np.ndarray:
    """The exact products y' y as whole numbers of any size."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * len(y) < 2**53:
        y = y.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, list] = {}
    for batch in batches:
        for _, y in numbers(batch.column(0)):
            dims = y.shape[1]
            held = totals.setdefault(dims, [0, np.zeros(dims, object), np.zeros((dims, dims), object)])
            held[0] += len(y)
            held[1] = held[1] + y.astype(object).sum(axis=0)
            held[2] = held[2] + scatter(y)
    for dims, (n, sums, products) in totals.items():
        i, j = np.triu_indices(dims)
        rows = [-1] + [-1] * dims + i.tolist()
        columns = [-1] + list(range(dims)) + j.tolist()
        values = [n, *sums.tolist(), *products[i, j].tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([dims] * len(rows), pa.int32()),
                pa.array(rows, pa.int32()),
                pa.array(columns, pa.int32()),
                pa.array(values, pa.decimal128(38, 0)),
            ],
            names=["dims", "i", "j", "total"],
        )


def primes(bound: int) -> list[int]:
    """The largest primes below 2**31 whose product exceeds ``bound``."""
    out, product, p = [], 1, 2**31 - 1
    while product <= bound:
        # These bases tell all numbers below 3,215,031,751 apart.
        if all(_maybe_prime(p, base) for base in (2, 3, 5, 7)):
            out.append(p)
            product *= p
        p -= 2
    return out


def _maybe_prime(p: int, base: int) -> bool:
    twos = (p - 1 & 1 - p).bit_length() - 1
    x = pow(base, (p - 1) >> twos, p)
    if x in (1, p - 1):
        return True
    for _ in range(twos - 1):
        x = x * x % p
        if x == p - 1:
            return True
    return False


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """det(x I - matrix) modulo p, from the highest power down; by Hessenberg form."""
    h = matrix.copy()
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        if below[0]:
            other = k + 1 + int(below[0])
            h[[k + 1, other]] = h[[other, k + 1]]
            h[:, [k + 1, other]] = h[:, [other, k + 1]]
        factors = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factors[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factors % p).sum(axis=1)) % p
    # Polynomials of the leading blocks, from the lowest power up.
    leading = np.zeros((d + 1, d + 1), np.int64)
    leading[0, 0] = 1
    for k in range(1, d + 1):
        factors = np.empty(k, np.int64)
        below = 1
        for i in range(k - 1, -1, -1):
            factors[i] = int(h[i, k - 1]) * below % p
            below = below * int(h[i, i - 1]) % p if i else 0
        own = -(leading[:k] * factors[:, None] % p).sum(axis=0) % p
        own[1:] = (own[1:] + leading[k - 1, :-1]) % p
        leading[k] = own
    return leading[d, ::-1].tolist()


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The exact characteristic polynomial of a symmetric matrix without negative roots."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # A coefficient is a symmetric function of the roots, at most that of equal ones.
    mean = -(-trace // d)
    moduli = primes(2 * max(comb(d, k) * mean**k for k in range(d + 1)))

    def reduced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        exact = np.array(matrix, object)
        for frame in frames:
            found = [polynomial_mod((exact % p).astype(np.int64), p) for p in frame.p.tolist()]
            yield pd.DataFrame({"p": frame.p, "coefficients": found})

    tasks = max(1, min(len(moduli), spark.sparkContext.defaultParallelism))
    todo = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(tasks)
    known = {r.p: r.coefficients for r in todo.mapInPandas(reduced, POLYNOMIALS).collect()}
    product = 1
    for p in moduli:
        product *= p
    shares = {p: product // p * pow(product // p, -1, p) for p in moduli}
    out = []
    for k in range(d + 1):
        value = sum(known[p][k] * share for p, share in shares.items()) % product
        out.append(value - product if 2 * value > product else value)
    return out


def roots_above(coefficients: list[int], a: int) -> int:
    """How many roots, with multiplicity, lie above ``a``; exact if all roots are real."""
    shifted = list(coefficients)
    for last in range(len(shifted) - 1, 0, -1):
        for i in range(1, last + 1):
            shifted[i] += a * shifted[i - 1]
    signs = [c > 0 for c in shifted if c]
    return sum(x != y for x, y in zip(signs[:-1], signs[1:], strict=True))


def _scaled(coefficients: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2**bits times as large."""
    return [c << (bits * k) for k, c in enumerate(coefficients)]


def _sign(coefficients: list[int], a: int) -> int:
    value = 0
    for c in coefficients:
        value = value * a + c
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], most: int) -> list[tuple[Fraction, int]]:
    """The ``most`` largest positive roots (or one more cluster) as (root, multiplicity), falling.

    Roots are narrowed to ``ROOT_BITS`` bits; those which agree in their first ``SAME_BITS`` bits are
    given as one.
    """
    poly = list(coefficients)
    while len(poly) > 1 and poly[-1] == 0:
        poly.pop()
    n_roots = len(poly) - 1
    if not n_roots:
        return []
    top = max(1, -poly[1])
    out, taken = [], 0
    # Parts (low, high] on the grid of 2**-bits, with the number of roots above each end.
    todo = [(0, top, n_roots, 0, 0)]
    scaled = {0: poly}
    while todo and taken < most:
        low, high, above_low, above_high, bits = todo.pop()
        n = above_low - above_high
        if not n:
            continue
        if n == 1:
            out.append((_narrowed(poly, low, high, bits), 1))
            taken += 1
            continue
        if high - low == 1:
            if low >> SAME_BITS:
                out.append((Fraction(2 * low + 1, 2 << bits), n))
                taken += n
                continue
            low, high, bits = low << 32, high << 32, bits + 32
        mid = (low + high) // 2
        if bits not in scaled:
            scaled[bits] = _scaled(poly, bits)
        above = roots_above(scaled[bits], mid)
        todo.append((low, mid, above_low, above, bits))
        todo.append((mid, high, above, above_high, bits))
    return out


def _narrowed(poly: list[int], low: int, high: int, bits: int) -> Fraction:
    """The only root in (low, high] / 2**bits."""
    here = _scaled(poly, bits)
    if _sign(here, high) == 0:
        return Fraction(high, 1 << bits)
    right = _sign(here, high)
    while (high - low) << ROOT_BITS > high:
        step = 8 if high - low < 1 << 8 else 0
        if step:
            low, high, bits = low << step, high << step, bits + step
            here = _scaled(poly, bits)
        mid = (low + high) // 2
        sign = _sign(here, mid)
        if sign == 0:
            return Fraction(mid, 1 << bits)
        low, high = (low, mid) if sign == right else (mid, high)
    return Fraction(low + high, 2 << bits)


def null_vectors(matrix: list[list[int]], root: Fraction, multiplicity: int) -> list[list[float]]:
    """Unit vectors that span the null space of matrix - root, the largest entry positive."""
    d = len(matrix)
    size = max(1, max(abs(v) for row in matrix for v in row)).bit_length()
    a = np.array(matrix, object) << FIXED_BITS
    shift = (root.numerator << FIXED_BITS) // root.denominator
    for i in range(d):
        a[i, i] -= shift
    a >>= size
    order = list(range(d))
    tiny = 1 << (FIXED_BITS // 4)
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        if k + 1 < d:
            a[k + 1 :, k] = (a[k + 1 :, k] << FIXED_BITS) // a[k, k]
            a[k + 1 :, k + 1 :] -= (a[k + 1 :, k, None] * a[k, k + 1 :]) >> FIXED_BITS

    def solved(b: np.ndarray) -> np.ndarray:
        y = b[order]
        for k in range(d):
            y[k + 1 :] -= (a[k + 1 :, k] * y[k]) >> FIXED_BITS
        for k in range(d - 1, -1, -1):
            y[k] = (y[k] << FIXED_BITS) // a[k, k]
            y[:k] -= (a[:k, k] * y[k]) >> FIXED_BITS
        return y

    def unit(y: np.ndarray) -> np.ndarray:
        length = isqrt(int((y * y).sum()))
        return (y << FIXED_BITS) // max(1, length)

    rng = np.random.default_rng(20251)
    found: list[np.ndarray] = []
    for _ in range(multiplicity):
        y = np.array([int(v) << (FIXED_BITS - 20) for v in rng.integers(1, 2**20, d)], object)
        for _ in range(3):
            y = unit(solved(unit(y)))
            for _ in range(2):
                for other in found:
                    y = y - ((other * (int((other * y).sum()) >> FIXED_BITS)) >> FIXED_BITS)
                y = unit(y)
        if y[max(range(d), key=lambda i: abs(y[i]))] < 0:
            y = -y
        found.append(y)
    return [[float(Fraction(int(v), 1 << FIXED_BITS)) for v in y] for y in found]


def principal(
    spark: SparkSession, matrix: list[list[int]], most: int
) -> tuple[list[Fraction], np.ndarray]:
    """The ``most`` largest positive roots with their unit vectors as rows, falling."""
    roots = largest_roots(characteristic(spark, matrix), most)
    if not roots:
        return [], np.empty((0, len(matrix)))

    def components(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [null_vectors(matrix, *roots[k]) for k in frame.number.tolist()]
            yield pd.DataFrame({"number": frame.number, "vectors": found})

    tasks = max(1, min(len(roots), spark.sparkContext.defaultParallelism))
    todo = spark.createDataFrame([(k,) for k in range(len(roots))], "number int").repartition(tasks)
    found = {r.number: r.vectors for r in todo.mapInPandas(components, COMPONENTS).collect()}
    values = [root for root, times in roots for _ in range(times)]
    vectors = [v for k in range(len(roots)) for v in found[k]]
    return values[:most], np.array(vectors[:most])


def fit(vectors: DataFrame, most: int) -> dict[int, Fit]:
    """A fit for the vectors of each length, from one scan of (id, vector)."""
    spark = vectors.sparkSession
    sums = (
        vectors.select("vector")
        .mapInArrow(_sum_rows, SUMS)
        .groupBy("dims", "i", "j")
        .agg(F.sum("total").alias("total"))
        .collect()
    )
    fits = {}
    for dims in sorted({row.dims for row in sums}):
        known = {(row.i, row.j): int(row.total) for row in sums if row.dims == dims}
        n = known[-1, -1]
        t = [known[-1, j] for j in range(dims)]
        # The same for x = y + SHIFT: a shift changes no scatter about the mean.
        matrix = [
            [n * known[min(i, j), max(i, j)] - t[i] * t[j] for j in range(dims)] for i in range(dims)
        ]
        trace = sum(matrix[i][i] for i in range(dims))
        roots, components = principal(spark, matrix, most)
        fits[dims] = Fit(n, t, roots, trace, components)
    return fits


def deviations(y: np.ndarray, fitted: Fit) -> np.ndarray:
    """n * y - T, exactly: as long numbers where these hold them, else as Python's."""
    largest = int(np.abs(y).max(initial=0)) * fitted.n + max(abs(t) for t in fitted.sums)
    if largest >= 2**62:
        return y.astype(object) * fitted.n - np.array(fitted.sums, object)
    return y * np.int64(fitted.n) - np.array(fitted.sums, np.int64)


def squares(d: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, exactly; None where it is no long number."""
    largest = int(np.abs(d).max(initial=0))
    if d.dtype != object and largest * largest * d.shape[1] < 2**63:
        return np.einsum("ij,ij->i", d, d).tolist()
    totals = (d.astype(object) ** 2).sum(axis=1).tolist()
    return [t if t < 2**63 else None for t in totals]


def _product_rows(fits: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for _, y in numbers(batch.column(0)):
                dims = y.shape[1]
                w = deviations(y, fits[dims]).astype(np.float64) @ fits[dims].directions()
                k = w.shape[1]
                held = totals.setdefault(dims, [np.zeros(k), np.zeros((k, k))])
                held[0] += w.sum(axis=0)
                held[1] += w.T @ w
        for dims, (sums, products) in totals.items():
            i, j = np.triu_indices(len(sums))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([dims] * (len(sums) + len(i)), pa.int32()),
                    pa.array([-1] * len(sums) + i.tolist(), pa.int32()),
                    pa.array(list(range(len(sums))) + j.tolist(), pa.int32()),
                    pa.array(np.concatenate([sums, products[i, j]])),
                ],
                names=["dims", "i", "j", "total"],
            )

    return run


def identity_errors(vectors: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Largest absolute entry of the whitened rows' covariance minus the identity, by length.

    Rows are centred without rounding before they are multiplied, so the mean that is taken off
    the products once more is itself no more than rounding.
    """
    sums = (
        vectors.select("vector")
        .mapInArrow(_product_rows(fits), PRODUCTS)
        .groupBy("dims", "i", "j")
        .agg(F.sum("total").alias("total"))
        .collect()
    )
    errors = dict.fromkeys(fits, 0.0)
    means = {(row.dims, row.j): row.total / fits[row.dims].n for row in sums if row.i < 0}
    for row in sums:
        if row.i >= 0:
            covariance = row.total / fits[row.dims].n - means[row.dims, row.i] * means[row.dims, row.j]
            errors[row.dims] = max(errors[row.dims], abs(covariance - (row.i == row.j)))
    return errors


def whitened(
    df: DataFrame, most: int = 32, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per vector and component: its place along the component, in deviations.

    Each entry c becomes x = floor(64 * c) + 1,000,000; the covariance is that of all usable
    vectors with divisor n. ``deviation`` is the exact sum of squares of n * x - S (null beyond a
    long), ``whitened`` the projection of x - S / n on the component over the square root of its
    eigenvalue, ``explained`` the eigenvalue's share of the trace, ``identity_error`` how far
    the covariance of the whitened rows is from the identity.

    Vectors that are null, empty, or hold null or non-finite entries (or such beyond 2**55) are
    left out. Repeated rows and ids count and return each time, a null id is returned as it is.
    Vectors of another length are whitened among themselves. Components of eigenvalue zero
    cannot be whitened and have no rows, so a table of equal vectors gives none. Equal
    eigenvalues get orthogonal components of their common space, the same for all rows. Only
    the two named columns are read.
    """
    vectors = usable(df, id_col, vector_col)
    fits = fit(vectors, most)
    errors = identity_errors(vectors, fits)
    id_type = vectors.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, y in numbers(batch.column(1)):
                fitted = fits[y.shape[1]]
                k = len(fitted.roots)
                if not k:
                    continue
                d = deviations(y, fitted)
                w = d.astype(np.float64) @ fitted.directions()
                shares = [float(root / fitted.trace) for root in fitted.roots]
                again = np.repeat(np.arange(len(places)), k)
                long = pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(places, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(places))),
                        pa.array(np.full(len(again), fitted.n, np.int64)),
                        pa.array(squares(d), long).take(pa.array(again)),
                        pa.array(w.reshape(-1)),
                        pa.array(np.tile(shares, len(places))),
                        pa.array(np.full(len(again), errors[y.shape[1]])),
                    ],
                    names=[id_col, *(f.split()[0] for f in WHITENED.split(", "))],
                )

    return vectors.mapInArrow(rows, f"`{id_col}` {id_type}, {WHITENED}")
