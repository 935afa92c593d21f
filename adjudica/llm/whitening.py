"""Principal-component whitening of integer vectors through the exact characteristic polynomial.

Entries become integers, floor(``scale`` * entry). The fit list holds every distinct integer vector once.
One pass over it sums 1, x and x x' exactly (in limbs of 20 bits, whose products stay exact in doubles), so
that the scatter M = n * sum(x x') - S S', which is n^2 times the covariance, is an integer matrix. Its
characteristic polynomial is found modulo primes below 2^31, by reduction to Hessenberg form; the primes are dealt
over Spark tasks, and as many are taken as the largest coefficient can need: with eigenvalues that are not negative, the
k-th elementary symmetric one is at most C(d, k) * (trace / d)^k. Chinese remaindering gives the coefficients.

All roots are real, so by Descartes' rule the sign changes of the polynomial shifted to a number count the
roots above it, with multiplicity. Bisection by that count isolates the largest roots; a root that is alone in its
interval is narrowed by signs, to 100 bits. Components are null vectors of M - root, by inverse iteration in integers
of more than 160 bits; a root of multiplicity m gets m orthogonal ones.

The driver holds matrices of the dimension and never a row of the table. All vectors meet their components again
in one pass without a shuffle.

Defined results: rows whose vector is null, empty, or holds a null or a non-finite entry are left out; a row with a
null id stays, repeated rows stay and count once in the fit list; vectors of another dimension are a fit of their own;
entries beyond 64 bits take the nearest 64-bit number; an eigenvalue of 0 is no component, so that equal vectors give no
rows; ties (a multiple eigenvalue) take any orthonormal basis, the same for all rows; an empty table gives no rows; other columns,
whatever their names, play no part. ``deviation`` is exact up to 38 digits and null beyond.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stored

LIMB = 20
#: Rows whose limb products a double sums exactly: 2 * LIMB + 12 bits.
CHUNK = 4096
#: Chunks whose integer sums stay below 2^62.
CHUNKS = 200
PRIMES_AT_ONCE = 16
ROOT_BITS = 100
SOLVE_BITS = 160


def sound(vector: str) -> Column:
    """Whether a vector takes part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(finite & (F.size(v) > 0), F.lit(False))


def integer_vector(vector: str, scale: float) -> Column:
    """floor(scale * entry) as longs."""
    return F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))))


# --- exact sums over the fit list -----------------------------------------------


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """x as a sum of limb_k * 2^(LIMB k): the last limb carries the sign."""
    out, rest = [], x
    while True:
        if int(rest.max(initial=0)) < 1 << LIMB and int(rest.min(initial=0)) >= -(1 << LIMB):
            return [*out, rest.astype(np.float64)]
        out.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
        rest = rest >> LIMB


def matrix_of(column: pa.Array) -> np.ndarray:
    """The rows of a list column of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Moments:
    """Exact sums of products of vectors of one dimension, with a first entry of 1."""

    def __init__(self, dim: int):
        self.dim, self.sums, self.chunks = dim, {}, 0

    def add(self, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(x), CHUNK):
            part = limbs(x[at : at + CHUNK])
            ones = [np.hstack([np.full((len(p), 1), float(k == 0)), p]) for k, p in enumerate(part)]
            for a, left in enumerate(ones):
                for b, right in enumerate(ones):
                    held = self.sums.setdefault(a + b, np.zeros((self.dim + 1, self.dim + 1), np.int64))
                    held += (left.T @ right).astype(np.int64)
            self.chunks += 1
            if self.chunks == CHUNKS:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        i, j = np.triu_indices(self.dim + 1)
        for limb, held in self.sums.items():
            fill = [np.full(len(i), v, np.int32) for v in (self.dim, limb)]
            columns = [*fill, i.astype(np.int32), j.astype(np.int32), held[i, j]]
            yield pa.record_batch([pa.array(c) for c in columns], names=["dim", "limb", "i", "j", "value"])
        self.sums, self.chunks = {}, 0


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, Moments] = {}
    for batch in batches:
        for dim, column in by_dimension(batch):
            yield from held.setdefault(dim, Moments(dim)).add(matrix_of(column["x"]))
    for moments in held.values():
        yield from moments.flush()


def by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch["dim"].to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        same = dims == dim
        yield int(dim), batch if same.all() else batch.filter(pa.array(same))


def scatter_of(fit_list: DataFrame) -> dict[int, tuple[int, list[int], np.ndarray]]:
    """For each dimension: n, S, and the integer scatter n * sum(x x') - S S'."""
    sums = (
        fit_list.select("dim", "x")
        .mapInArrow(_moments, "dim int, limb int, i int, j int, value long")
        .groupBy("dim", "limb", "i", "j")
        .agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value"))
    )
    whole: dict[int, np.ndarray] = {}
    for r in sums.collect():  # a number for each pair of entries and limb
        m = whole.setdefault(r.dim, np.zeros((r.dim + 1, r.dim + 1), object))
        add = int(r.value) << (LIMB * r.limb)
        m[r.i, r.j] += add
        if r.i != r.j:
            m[r.j, r.i] += add
    out = {}
    for dim, m in whole.items():
        n, s = m[0, 0], m[0, 1:]
        out[dim] = (int(n), [int(v) for v in s], n * m[1:, 1:] - np.outer(s, s))
    return out


# --- characteristic polynomial --------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller and Rabin's test, exact below 3 * 10^9 with these bases."""
    if n % 2 == 0:
        return n == 2
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for base in (2, 3, 5, 7):
        if n == base:
            return True
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return n > 1


def primes_beyond(bound: int) -> list[int]:
    """Primes downwards from 2^31 whose product exceeds ``bound``."""
    out, product, n = [], 1, 2**31 - 1
    while product <= bound:
        if is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def coefficient_bound(matrix: np.ndarray) -> int:
    d, trace = len(matrix), sum(matrix.diagonal())
    return max(-(-math.comb(d, k) * trace**k // d**k) for k in range(d + 1))


def hessenberg(h: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Similar Hessenberg matrices of a stack of matrices, each modulo its prime."""
    p1, p2 = primes[:, None], primes[:, None, None]
    for k in range(h.shape[1] - 2):
        column = h[:, k + 1 :, k]
        first = (column != 0).argmax(axis=1)
        for at in np.flatnonzero(first):
            pair, swapped = [k + 1, k + 1 + first[at]], [k + 1 + first[at], k + 1]
            h[at, pair] = h[at, swapped]
            h[at, :, pair] = h[at, :, swapped]
        inverse = np.array([pow(int(v), -1, int(p)) if v else 0 for v, p in zip(h[:, k + 1, k], primes)], np.int64)
        factor = h[:, k + 2 :, k] * inverse[:, None] % p1
        h[:, k + 2 :, :] = (h[:, k + 2 :, :] - factor[:, :, None] * h[:, None, k + 1, :]) % p2
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2 :] * factor[:, None, :] % p2).sum(axis=2)) % p1
    return h


def polynomial_of(h: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Coefficients, constant first, of the characteristic polynomials of Hessenberg matrices."""
    count, d = h.shape[:2]
    p1, p2 = primes[:, None], primes[:, None, None]
    lead = np.zeros((count, d + 1, d + 1), np.int64)  # of the leading blocks
    lead[:, 0, 0] = 1
    for m in range(1, d + 1):
        new = np.zeros((count, d + 1), np.int64)
        new[:, 1:] = lead[:, m - 1, :-1]
        new -= h[:, m - 1, m - 1, None] * lead[:, m - 1] % p1
        if m > 1:
            below, chain = np.ones(count, np.int64), np.empty((count, m - 1), np.int64)
            for i in range(m - 2, -1, -1):
                below = below * h[:, i + 1, i] % primes
                chain[:, i] = h[:, i, m - 1] * below % primes
            new -= (chain[:, :, None] * lead[:, : m - 1] % p2).sum(axis=1)
        lead[:, m] = new % p1
    return lead[:, d]


def remainders(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """Characteristic polynomial of an integer matrix modulo each prime."""
    p = np.array(primes, np.int64)
    stack = np.stack([(matrix % q).astype(np.int64) for q in primes])
    return polynomial_of(hessenberg(stack, p), p)


def chinese(residues: list[int], primes: list[int]) -> int:
    value, product = 0, 1
    for r, p in zip(residues, primes):
        value += product * ((r - value) * pow(product, -1, p) % p)
        product *= p
    return value


def symmetric_functions(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Elementary symmetric functions of the eigenvalues: the polynomial's coefficients without signs."""
    d, primes = len(matrix), primes_beyond(coefficient_bound(matrix))
    groups = [primes[i : i + PRIMES_AT_ONCE] for i in range(0, len(primes), PRIMES_AT_ONCE)]
    sent = spark.sparkContext.broadcast(pickle.dumps(matrix))  # the square of the dimension, whatever the rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = None
        for batch in batches:
            m = pickle.loads(sent.value) if m is None else m
            for at in batch["id"].to_pylist():
                found = remainders(m, groups[at])
                yield pa.record_batch([pa.array(groups[at], pa.int64()), pa.array(list(found), pa.list_(pa.int64()))], names=["prime", "residues"])

    numbers = spark.range(0, len(groups), 1, min(len(groups), 4096))
    by_prime = {r.prime: r.residues for r in numbers.mapInArrow(run, "prime long, residues array<long>").collect()}
    sent.destroy()
    # the sign of the coefficient of x^(d - k) is that of (-1)^k
    return [
        chinese([(-1) ** k * by_prime[p][d - k] % p for p in primes], primes)
        for k in range(d + 1)
    ]


# --- roots ----------------------------------------------------------------------


class RealRoots:
    """Largest roots of x^d - e1 x^(d-1) + e2 x^(d-2) - ..., all of them real and none negative."""

    def __init__(self, functions: list[int]):
        self.d = len(functions) - 1
        self.high_first = [(-1) ** k * e for k, e in enumerate(functions)]
        self.top = functions[1] if self.d else 0
        self.positive = max(k for k, e in enumerate(functions) if e)
        self.counted: dict[tuple[int, int], int] = {}

    def above(self, a: int, shift: int) -> int:
        """Number of roots larger than a / 2^shift, with multiplicity: sign changes after moving 0 there."""
        if (a, shift) not in self.counted:
            c = [v << (shift * k) for k, v in enumerate(self.high_first)]
            for last in range(self.d, 0, -1):
                for k in range(1, last + 1):
                    c[k] += a * c[k - 1]
            signs = [v > 0 for v in c if v]
            self.counted[a, shift] = sum(x != y for x, y in zip(signs, signs[1:]))
        return self.counted[a, shift]

    def sign(self, a: int, shift: int) -> int:
        value = 0
        for k, v in enumerate(self.high_first):
            value = value * a + (v << (shift * k))
        return (value > 0) - (value < 0)

    def largest(self, j: int) -> tuple[int, int]:
        """(a, shift): the j-th root from above lies in ((a - 1) / 2^shift, a / 2^shift]."""
        low, high, shift = 0, self.top, 0
        alone = False
        while True:
            if high - low == 1:
                if high.bit_length() >= ROOT_BITS:
                    return high, shift
                more = ROOT_BITS - high.bit_length()
                low, high, shift = low << more, high << more, shift + more
            alone = alone or (self.above(low, shift) == j and self.above(high, shift) == j - 1)
            middle = (low + high) // 2
            if alone:
                # just above the root the sign is that of (-1)^(j - 1)
                reached = self.sign(middle, shift) * (-1) ** (j - 1) >= 0
            else:
                reached = self.above(middle, shift) < j
            low, high = (low, middle) if reached else (middle, high)


# --- components -----------------------------------------------------------------


def solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """matrix^-1 right * 2^SOLVE_BITS in integers, by elimination with pivots; a pivot of 0 counts as 1."""
    u, b, d = matrix.copy(), right.copy(), len(matrix)
    for k in range(d):
        at = k + max(range(d - k), key=lambda i: abs(u[k + i, k]))
        if at != k:
            u[[k, at]], b[[k, at]] = u[[at, k]], b[[at, k]]
        if not u[k, k]:
            u[k, k] = 1
        factor = (u[k + 1 :, k] << SOLVE_BITS) // u[k, k]
        u[k + 1 :, k:] -= factor[:, None] * u[k, k:] >> SOLVE_BITS
        b[k + 1 :] -= factor[:, None] * b[k] >> SOLVE_BITS
    x = np.zeros_like(b)
    for k in range(d - 1, -1, -1):
        x[k] = ((b[k] << SOLVE_BITS) - u[k, k + 1 :] @ x[k + 1 :]) // u[k, k]
    return x


def orthonormal(columns: np.ndarray) -> np.ndarray:
    """Columns of length 2^SOLVE_BITS that span the same space."""
    out = []
    for v in columns.T:
        # a long vector first loses its common size
        v = (v << SOLVE_BITS) // max(1, max(abs(int(a)) for a in v))
        for _ in range(2):
            for w in out:
                v = v - ((w * (int(v @ w) >> SOLVE_BITS)) >> SOLVE_BITS)
            v = (v << SOLVE_BITS) // max(1, math.isqrt(int(v @ v)))
        out.append(v)
    return np.stack(out, axis=1)


def null_vectors(matrix: np.ndarray, root: tuple[int, int], how_many: int) -> np.ndarray:
    """Orthonormal null vectors of matrix - root as doubles, one a column; the largest entry is positive."""
    a, shift = root
    d, extra = len(matrix), SOLVE_BITS
    shifted = matrix * (1 << (shift + extra))
    for i in range(d):
        shifted[i, i] -= a << extra
    random = np.random.default_rng(7)
    x = random.integers(-(2**40), 2**40, (d, how_many)).astype(object) * (1 << SOLVE_BITS)
    for _ in range(3):
        x = orthonormal(solve(shifted, x))
    out = np.array([[float(Fraction(int(v), 1 << SOLVE_BITS)) for v in row] for row in x])
    return out * np.sign(out[np.abs(out).argmax(axis=0), np.arange(how_many)])


class Whitening:
    """Fitted components of one dimension."""

    def __init__(self, n: int, sums: list[int], scatter: np.ndarray, functions: list[int], components: int):
        self.n, self.sums = n, sums
        roots = RealRoots(functions)
        found = [roots.largest(j) for j in range(1, min(components, roots.positive) + 1)]
        trace = sum(scatter.diagonal())
        values = [Fraction(a, 1 << shift) for a, shift in found]
        self.explained = [float(v / trace) for v in values]
        directions = [null_vectors(scatter, r, found.count(r)) for r in dict.fromkeys(found)]
        # (n x - S) . w / (n sqrt(root / n^2)) = (n x - S) . w / sqrt(root)
        self.map = (
            np.hstack(directions) / np.array([math.sqrt(v) for v in values]) if found else np.zeros((len(sums), 0))
        )

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        largest = self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, self.sums), default=0)
        if largest**2 * x.shape[1] < 2**62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def scores(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(np.float64) @ self.map

    def identity_error(self, moments: np.ndarray) -> float:
        k = self.map.shape[1]
        mean, square = moments[:k] / self.n, moments[k:].reshape(k, k) / self.n
        return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def fit(fit_list: DataFrame, components: int = 4) -> dict[int, Whitening]:
    """A ``Whitening`` for each dimension of a list of distinct vectors (dim, x)."""
    spark = fit_list.sparkSession
    return {
        dim: Whitening(n, sums, scatter, symmetric_functions(spark, scatter), components)
        for dim, (n, sums, scatter) in sorted(scatter_of(fit_list).items())
    }


def whitened_moments(fit_list: DataFrame, fitted: dict[int, Whitening]) -> dict[int, np.ndarray]:
    """Sums of the whitened vectors, and of their products, over the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, rows in by_dimension(batch):
                z = fitted[dim].scores(fitted[dim].centred(matrix_of(rows["x"])))
                held[dim] = held.get(dim, 0.0) + np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])
        for dim, sums in held.items():
            fill = [np.full(len(sums), dim, np.int32), np.arange(len(sums), dtype=np.int32), sums]
            yield pa.record_batch([pa.array(c) for c in fill], names=["dim", "i", "value"])

    sums = fit_list.select("dim", "x").mapInArrow(run, "dim int, i int, value double").groupBy("dim", "i").agg(F.sum("value").alias("value"))
    out = {dim: np.zeros(w.map.shape[1] * (w.map.shape[1] + 1)) for dim, w in fitted.items()}
    for r in sums.collect():  # components * (components + 1) numbers
        out[r.dim][r.i] = r.value
    return out


def whiten(vectors: DataFrame, components: int = 4, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every row and component."""
    x = integer_vector(vector, scale)
    rows = vectors.where(sound(vector)).select(F.col(key).cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.withColumn("dim", F.size("x"))
    fit_list = stored(rows.select("dim", "x").distinct(), "whitening-fit-list")
    fitted = fit(fit_list, components)
    moments = whitened_moments(fit_list, fitted)
    errors = {dim: w.identity_error(moments[dim]) for dim, w in fitted.items()}
    schema = pa.schema([
        ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.decimal128(38, 0)),
        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
    ])

    def deviations(centred: np.ndarray) -> pa.Array:
        if centred.dtype == np.int64:
            return pa.array(np.einsum("ij,ij->i", centred, centred)).cast(pa.decimal128(38, 0))
        sums = [int(v) for v in (centred * centred).sum(axis=1)]
        return pa.array([v if v < 10**38 else None for v in sums], pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, held in by_dimension(batch):
                w = fitted[dim]
                k = w.map.shape[1]
                centred = w.centred(matrix_of(held["x"]))
                at = pa.array(np.repeat(np.arange(len(held)), k))
                whitened, size = w.scores(centred).ravel(), len(held) * k
                yield pa.record_batch(
                    [
                        held["vec_id"].take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(held))),
                        pa.array(np.full(size, w.n)), deviations(centred).take(at), pa.array(whitened),
                        pa.array(np.tile(w.explained, len(held)), pa.float64()), pa.array(np.full(size, errors[dim])),
                    ],
                    schema=schema,
                )

    return rows.mapInArrow(
        run, "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
