"""Whitening of embeddings from the exact characteristic polynomial of their integer scatter.

Entries become whole numbers, so sums of products over any number of rows are exact. The scatter's characteristic
polynomial is found modulo many primes (by Hessenberg reduction) and put together by Chinese remainders; its real
roots are isolated by exact counts, and components are null vectors of the scatter less a root, by inverse iteration.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import shared_value
from sparkmart.session import settle

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
ROWS = 4096  # vectors that are multiplied at a time
LIMB = 40  # bits of a sum that go to Spark in one number
ISOLATED = 20  # bits to which roots are told apart by counts before they are refined by signs
PRECISE = 150  # bits of a root; roots that agree to so many bits are one root of some multiplicity
FIXED = 300  # fraction bits of numbers in the inverse iteration
LARGEST = 2.0**62  # entries whose whole number is not below this count as not finite


def _whole_vectors(batch: pa.RecordBatch):
    """Mask of the rows that stay, and their vectors of whole numbers, flat, with the lengths."""
    lists = batch.column("embedding").cast(pa.list_(pa.float64()))
    lengths = pc.list_value_length(lists).fill_null(-1).to_numpy()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    size = np.maximum(lengths, 0)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(SCALE * values)
        bad = ~(np.abs(scaled) < LARGEST)  # NaN included
    row = np.repeat(np.arange(len(size)), size)
    stays = (lengths > 0) & (np.bincount(row[bad], minlength=len(size)) == 0)
    return stays, scaled[stays[row]].astype(np.int64) + OFFSET, size[stays]


def _coded(embeddings: DataFrame) -> DataFrame:
    """``vec_id, dims, x`` of the rows that stay; ``x`` holds the whole numbers, eight bytes each."""

    def run(batches):
        for batch in batches:
            stays, x, sizes = _whole_vectors(batch)
            ends = np.concatenate([[0], np.cumsum(sizes)]) * 8
            data = x.astype("<i8").tobytes()
            coded = pa.array([data[a:b] for a, b in zip(ends, ends[1:])], pa.binary())
            kept = batch.column("vec_id").filter(pa.array(stays))
            yield pa.RecordBatch.from_arrays([kept, pa.array(sizes.astype(np.int32)), coded], names=["vec_id", "dims", "x"])

    rows = embeddings.select("vec_id", "embedding")
    schema = rows.select("vec_id", F.lit(0).alias("dims"), F.lit(None).cast("binary").alias("x")).schema
    return rows.mapInArrow(run, schema)


def _matrices(batches, dims: int):
    """Vectors of a task less OFFSET, at most ROWS of them at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            data = b"".join(part.column("x").to_pylist())
            yield part, np.frombuffer(data, "<i8").reshape(-1, dims) - OFFSET


def _products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y``, exact whatever the sizes."""
    most = int(np.abs(y).max(initial=0)) ** 2 * len(y)
    if most < 1 << 53:
        z = y.astype(float)
        return (z.T @ z).astype(np.int64).astype(object)
    if most < 1 << 63:
        return (y.T @ y).astype(object)
    z = y.astype(object)
    return z.T @ z


def _limbs(values: list[int]):
    """(entry, limb, value) of whole numbers of any size."""
    for entry, value in enumerate(values):
        sign, rest, limb = (-1 if value < 0 else 1), abs(int(value)), 0
        while rest:
            yield entry, limb, sign * (rest & ((1 << LIMB) - 1))
            rest >>= LIMB
            limb += 1


def _scatter(fit: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, their sums, and n * (sum of products) - (products of sums), exact."""
    upper = np.triu_indices(dims)

    def run(batches):
        n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for _, y in _matrices(batches, dims):
            n += len(y)
            sums = sums + y.astype(object).sum(axis=0)
            products = products + _products(y)
        rows = list(_limbs([n, *sums, *products[upper]]))
        if rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["entry", "limb", "value"])

    parts = fit.select("x").mapInArrow(run, "entry long, limb int, value long")
    # about dims * dims rows, whatever the number of vectors
    total = parts.groupBy("entry", "limb").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value")).toArrow()
    held = [0] * (1 + dims + len(upper[0]))
    for entry, limb, value in zip(*(total.column(c).to_pylist() for c in ("entry", "limb", "value"))):
        held[entry] += int(value) << (LIMB * limb)
    n, sums = held[0], held[1 : dims + 1]
    scatter = np.zeros((dims, dims), object)
    for i, j, value in zip(*upper, held[dims + 1 :]):
        scatter[i, j] = scatter[j, i] = n * value - sums[i] * sums[j]
    return n, sums, scatter


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 2**32."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients, from the constant on, of det(t - matrix) modulo the prime ``p`` below 2**31."""
    d = len(matrix)
    h = (matrix % p).astype(np.int64)
    for k in range(1, d - 1):
        found = np.flatnonzero(h[k:, k - 1])
        if not len(found):
            continue
        i = k + int(found[0])
        h[[k, i]] = h[[i, k]]
        h[:, [k, i]] = h[:, [i, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k]) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factor % p).sum(axis=1)) % p
    polynomials = np.zeros((d + 1, d + 1), np.int64)
    polynomials[0, 0] = 1
    for k in range(1, d + 1):
        row = np.roll(polynomials[k - 1], 1)
        row = row - h[k - 1, k - 1] * polynomials[k - 1] % p
        chain = 1
        for i in range(k - 1, 0, -1):  # along the subdiagonal
            chain = chain * int(h[i, i - 1]) % p
            if not chain:
                break
            row = row - (int(h[i - 1, k - 1]) * chain % p) * polynomials[i - 1] % p
        polynomials[k] = row % p
    return polynomials[d].tolist()


def characteristic_polynomial(spark: SparkSession, scatter: np.ndarray) -> list[int]:
    """Elementary symmetric sums of the eigenvalues of a positive semidefinite matrix of whole numbers.

    All are at most (1 + trace / d) ** d, as eigenvalues are not negative, so that many primes are taken; each is
    the work of a task's row.
    """
    d = len(scatter)
    trace = int(np.trace(scatter))
    bound = (2 + trace // d) ** d
    primes, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(p):
            primes.append(p)
            product *= p
        p -= 2
    held = shared_value(spark, scatter)

    def run(batches):
        matrix = held()
        for batch in batches:
            wanted = batch.column("prime").to_pylist()
            found = pa.array([polynomial_modulo(matrix, p) for p in wanted], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("prime"), found], names=["prime", "coefficients"])

    asked = spark.createDataFrame([(p,) for p in primes], "prime long")
    rows = asked.mapInArrow(run, "prime long, coefficients array<long>").toArrow()
    sums, modulus = [0] * (d + 1), 1
    for p, coefficients in zip(rows.column("prime").to_pylist(), rows.column("coefficients").to_pylist()):
        inverse = pow(modulus, -1, p)
        for k in range(d + 1):
            residue = coefficients[d - k] * (-1) ** k
            sums[k] += modulus * ((residue - sums[k]) * inverse % p)
        modulus *= p
    return sums


@dataclass
class Root:
    """A root (its numerator over 2**shift) and how many eigenvalues it stands for."""

    numerator: int
    shift: int
    count: int


def _shifted(coefficients: list[int], u: int, s: int) -> list[int]:
    """Coefficients of the polynomial around u / 2**s, times a power of two."""
    r = len(coefficients) - 1
    out = [c << (s * (r - k)) for k, c in enumerate(coefficients)]
    for i in range(r):
        for k in range(r - 1, i - 1, -1):
            out[k] += u * out[k + 1]
    return out


def roots_above(coefficients: list[int], u: int, s: int) -> int:
    """Roots larger than u / 2**s, counted as often as they occur; exact if all roots are real (rule of signs)."""
    signs = [c > 0 for c in _shifted(coefficients, u, s) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(coefficients: list[int], u: int, s: int) -> int:
    value, r = 0, len(coefficients) - 1
    for k in range(r, -1, -1):
        value = value * u + (coefficients[k] << (s * (r - k)))
    return (value > 0) - (value < 0)


def largest_roots(sums: list[int], wanted: int) -> list[Root]:
    """The largest roots, at least ``wanted`` with their multiplicity (if there are so many above zero)."""
    rank = max(k for k, e in enumerate(sums) if e)
    coefficients = [(-1) ** (rank - k) * sums[rank - k] for k in range(rank + 1)]
    out: list[Root] = []
    found, top, coarse = 0, sums[1], 0
    while found < min(wanted, rank):
        s = coarse
        lo, hi, above_lo = 0, top, rank  # more than ``found`` roots above lo, ``found`` above hi
        while True:
            width = hi - lo
            if above_lo == found + 1 and width << ISOLATED <= hi:
                break
            if width << PRECISE <= hi:
                break
            if width < 2:
                lo, hi, s = 2 * lo, 2 * hi, s + 1
            middle = (lo + hi) // 2
            count = roots_above(coefficients, middle, s)
            if count > found:
                lo, above_lo = middle, count
            else:
                hi = middle
        top, coarse = lo, s
        # one root, and hi is above it or the root itself: its sign tells on which side a point lies
        if above_lo == found + 1 and _sign(coefficients, hi, s) != 0:
            side = _sign(coefficients, hi, s)
            while (hi - lo) << PRECISE > hi:
                lo, hi, s = 2 * lo, 2 * hi, s + 1
                middle = (lo + hi) // 2
                here = _sign(coefficients, middle, s)
                if here == side or here == 0:
                    hi = middle
                else:
                    lo = middle
                if here == 0:
                    break
        out.append(Root(hi if _sign(coefficients, hi, s) == 0 else (lo + hi) // 2, s, above_lo - found))
        found = above_lo
    return out


def null_vectors(matrix: np.ndarray, root: Root) -> np.ndarray:
    """Unit vectors (one in a row) of the matrix for one root, by inverse iteration in fixed-point numbers."""
    d = len(matrix)
    eigenvalue = (root.numerator << FIXED) >> root.shift
    lu = np.array([[int(x) << FIXED for x in row] for row in matrix], object)
    lu[np.arange(d), np.arange(d)] -= eigenvalue
    swaps = []
    for k in range(d):
        i = max(range(k, d), key=lambda i: abs(lu[i, k]))
        swaps.append(i)
        if i != k:
            lu[[k, i]] = lu[[i, k]]
        if not lu[k, k]:
            lu[k, k] = 1  # singular to the last bit, as it should be
        for i in range(k + 1, d):
            if lu[i, k]:
                lu[i, k] = (lu[i, k] << FIXED) // lu[k, k]
                lu[i, k + 1 :] -= (lu[i, k] * lu[k, k + 1 :]) >> FIXED

    def solved(b: list[int]) -> list[int]:
        x = list(b)
        for k, i in enumerate(swaps):
            x[k], x[i] = x[i], x[k]
            for j in range(k + 1, d):
                x[j] -= (lu[j, k] * x[k]) >> FIXED
        for k in range(d - 1, -1, -1):
            rest = x[k] - (sum(lu[k, j] * x[j] for j in range(k + 1, d)) >> FIXED)
            x[k] = (rest << FIXED) // lu[k, k]
        return x

    def unit(x: list[int], others: list[list[int]]) -> list[int]:
        for other in others:
            share = sum(a * b for a, b in zip(x, other)) >> FIXED
            x = [a - ((share * b) >> FIXED) for a, b in zip(x, other)]
        # a common size first, so that the fixed-point numbers keep their digits
        up = max(0, FIXED - max(map(int.bit_length, x)))
        x = [a << up for a in x]
        length = isqrt(sum(a * a for a in x))
        return [(a << FIXED) // length for a in x]

    rng = np.random.default_rng(12)
    found: list[list[int]] = []
    for _ in range(root.count):
        x = unit([int(a) << (FIXED - 40) for a in rng.integers(-(2**40), 2**40, d)], found)
        for _ in range(3):
            x = unit(unit(solved(x), found), found)
        found.append(x)
    return np.array([[a / (1 << FIXED) for a in x] for x in found])


@dataclass
class Whitening:
    """What is known of the fit: vectors ``n``, their sums, unit components (in rows) by falling eigenvalue, and
    each eigenvalue's share of the trace. ``sums`` are of the entries less OFFSET.
    """

    n: int
    dims: int
    sums: list[int]
    polynomial: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n times the vectors less their sums, exact (``y``: entries less OFFSET)."""
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.sums), default=0)
        if most < 1 << 62:
            return self.n * y - np.array(self.sums, np.int64)
        return self.n * y.astype(object) - np.array(self.sums, object)

    def deviations(self, z: np.ndarray) -> list:
        """Sums of squares of centred vectors; none where they do not fit in a long."""
        if z.dtype != object and int(np.abs(z).max(initial=0)) ** 2 * self.dims < 1 << 63:
            return (z * z).sum(axis=1).tolist()
        return [x if x < 1 << 63 else None for x in (z.astype(object) ** 2).sum(axis=1)]

    def whitened(self, z: np.ndarray) -> np.ndarray:
        return (z.astype(float) / self.n) @ self.components.T / np.sqrt(self.eigenvalues)


def _components(spark: SparkSession, scatter: np.ndarray, roots: list[Root]) -> np.ndarray:
    """The null vectors of every root, each root the work of a task's row."""
    held = shared_value(spark, (scatter, roots))

    def run(batches):
        matrix, known = held()
        for batch in batches:
            wanted = batch.column("root").to_pylist()
            found = pa.array([null_vectors(matrix, known[i]).ravel().tolist() for i in wanted], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("root"), found], names=["root", "vectors"])

    asked = spark.createDataFrame([(i,) for i in range(len(roots))], "root int")
    rows = asked.mapInArrow(run, "root int, vectors array<double>").collect()
    return np.concatenate([np.array(r.vectors).reshape(-1, len(scatter)) for r in sorted(rows, key=lambda r: r.root)])


def _fit(spark: SparkSession, fit: DataFrame, dims: int, components: int) -> Whitening:
    n, sums, scatter = _scatter(fit, dims)
    trace = int(np.trace(scatter)) if dims else 0
    if not trace:  # no vector, or always the same
        none = np.zeros(0)
        return Whitening(n, dims, sums, [1], np.zeros((0, dims)), none, none)
    polynomial = characteristic_polynomial(spark, scatter)
    roots = largest_roots(polynomial, components)
    vectors = _components(spark, scatter, roots)[:components]
    values = [(r.numerator, r.shift) for r in roots for _ in range(r.count)][:components]
    return Whitening(
        n, dims, sums, polynomial, vectors,
        np.array([u / ((n * n) << s) for u, s in values]), np.array([u / (trace << s) for u, s in values]),
    )


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit vectors less the identity."""
    c = len(model.components)
    held = shared_value(fit.sparkSession, model)

    def run(batches):
        known = held()
        total, products = np.zeros(c), np.zeros((c, c))
        for _, y in _matrices(batches, known.dims):
            w = known.whitened(known.centred(y))
            total, products = total + w.sum(axis=0), products + w.T @ w
        entries = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(entries))), pa.array(entries)], names=["entry", "value"])

    parts = fit.select("x").mapInArrow(run, "entry long, value double")
    held_sums = np.zeros(c + c * c)
    for row in parts.groupBy("entry").agg(F.sum("value").alias("value")).collect():  # c + c * c rows
        held_sums[row.entry] = row.value
    mean, second = held_sums[:c] / model.n, held_sums[c:].reshape(c, c) / model.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(c)).max(initial=0))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening]:
    """Whitened rows (see ``whitened_rows``) and the fit behind them."""
    spark = embeddings.sparkSession
    coded = settle(_coded(embeddings), "whiten-vectors")
    sizes = coded.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "dims")).alias("top")).first().top
    dims = sizes.dims if sizes else 0
    vectors = coded.where(F.col("dims") == dims)
    fit = settle(vectors.select("x").distinct(), "whiten-fit")
    model = _fit(spark, fit, dims, components)
    error = _identity_error(fit, model) if len(model.components) else 0.0
    held = shared_value(spark, (model, error))
    c = len(model.components)

    def run(batches):
        known, error = held()
        for part, y in _matrices(batches, dims):
            z = known.centred(y)
            rows = len(y)
            deviation = pa.array(known.deviations(z), pa.int64())
            each = pa.array(np.repeat(np.arange(rows), c))
            columns = [
                part.column("vec_id").take(each), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * c, known.n)), deviation.take(each), pa.array(known.whitened(z).ravel()),
                pa.array(np.tile(known.explained, rows)), pa.array(np.full(rows * c, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    schema = vectors.select(
        "vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("deviation"),
        F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"),
    ).schema
    rows = vectors.select("vec_id", "x") if c else vectors.select("vec_id", "x").limit(0)
    return rows.mapInArrow(run, schema), model


def whitened_rows(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row and component.

    Rows drop out whose vector is null or empty, or holds a null, an entry that is not finite or one too large for a whole number
    below 2**62. Every other row counts; the fit takes equal vectors of whole numbers once. A space has one number of
    dimensions: that of most rows (the larger, if two are as frequent); rows of another length have no place in it and
    drop out. Components are those with an eigenvalue above zero, so fewer where vectors are few or alike, and none (no rows)
    for an empty table or one vector alone. Equal eigenvalues have some orthonormal basis of their space. ``deviation`` is null where it does
    not fit in a long. Null ids and repeated rows are kept. Other columns are not read.

    What grows with the rows stays in Spark; the driver and the tasks hold matrices of dims by dims numbers.
    """
    return whiten(embeddings, components)[0]
