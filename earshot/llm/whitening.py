"""Embedding whitening by exact spectra.

Vectors become integer vectors: ``floor(SCALE * entry) + SHIFT``. Equal ones count once; their count, sums and products of entries
are added up exactly (in tasks by integer arithmetic, over tasks by decimal sums). ``n * products - sums * sums`` is an integer
matrix, n**2 times the covariance. Its characteristic polynomial is found modulo many primes in Spark tasks and put together by Chinese
remaindering; its largest roots are isolated exactly and refined to ``BITS`` bits; components are its null vectors (``exact_roots``).

What reaches the driver depends on the dimension only: d * (d + 1) / 2 sums and d + 1 residues for each prime (for 64 dimensions and
50,000 vectors about 100 primes). The work on the polynomial grows with the fourth power of the dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import Scratch, empty_as, mapped, ship
from earshot.llm.exact_roots import DIGITS, coefficient_bound, combined, decimal, largest_roots, null_vectors, primes_for, residues

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
# Entries from this on cannot be held as exact integers; they count as not finite.
LARGEST = float(1 << 45)
# Products are added up in doubles while all sums stay below 2**53, in Python's integers beyond 2**62.
PRIMES_PER_TASK = 16


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: count and sums of the fit list, and components with their share of the variance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # (components, dimensions), unit length
    values: tuple[float, ...]  # their variances
    explained: tuple[float, ...]


def integer_vectors(rows: DataFrame, key: str, vector: str, dimensions: int) -> DataFrame:
    """(key, x): the bytes of 64-bit integers, less ``SHIFT``; short vectors are filled up with zeros."""
    entries = F.col(vector).cast("array<double>")
    filled = F.concat(entries, F.array_repeat(F.lit(0.0), F.lit(dimensions) - F.size(entries)))

    def convert(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = batch.column("v").flatten().to_numpy(zero_copy_only=False)
        x = np.floor(SCALE * values).astype("<i8")
        width = 8 * dimensions
        data = pa.array([x.data.cast("B")[i : i + width].tobytes() for i in range(0, 8 * len(x), width)], pa.binary())
        yield pa.record_batch([batch.column("key"), data], names=["key", "x"])

    good = usable(rows, vector).select(F.col(key).cast("long").alias("key"), filled.alias("v"))
    return mapped(good, convert, "key long, x binary")


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and holds finite entries only."""
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) >= LARGEST)
    return rows.where(F.col(vector).isNotNull() & ~F.coalesce(F.exists(F.col(vector).cast("array<double>"), bad), F.lit(True)))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i8").reshape(-1, dimensions)


def _exact_products(x: np.ndarray) -> np.ndarray:
    """The sums of products of all pairs of columns, as Python integers or 64-bit ones."""
    largest = int(np.abs(x).max(initial=0))
    if largest * largest * len(x) < 1 << 53:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64)
    if largest * largest * len(x) < 1 << 62:
        return x.T @ x
    y = x.astype(object)
    return y.T @ y


def sums_of_products(vectors: DataFrame, dimensions: int) -> tuple[int, list[int], list[list[int]]]:
    """Count, sums and products of entries over all vectors, exactly."""
    names = ["i", "j", "high", "low"]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dimensions, object), np.zeros((dimensions, dimensions), object)
        for batch in batches:
            x = _matrix(batch.column("x"), dimensions)
            n += len(x)
            sums = sums + x.astype(object).sum(axis=0) if len(x) else sums
            products = products + _exact_products(x).astype(object)
        if n:
            cells = [(-1, -1, n), *((-1, j, int(s)) for j, s in enumerate(sums))]
            cells += [(i, j, int(products[i, j])) for i in range(dimensions) for j in range(i, dimensions)]
            wide = pa.decimal128(38, 0)
            high = pa.array([Decimal(v >> 60) for _, _, v in cells], wide)
            low = pa.array([Decimal(v & ((1 << 60) - 1)) for _, _, v in cells], wide)
            yield pa.record_batch([pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()), high, low], names=names)

    ship(vectors.sparkSession)
    cells = vectors.select("x").mapInArrow(add_up, "i int, j int, high decimal(38,0), low decimal(38,0)")
    total = cells.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    value = {(r["i"], r["j"]): (int(r["high"]) << 60) + int(r["low"]) for r in total}
    n = value.get((-1, -1), 0)
    sums = [value.get((-1, j), 0) for j in range(dimensions)]
    products = [[value.get((min(i, j), max(i, j)), 0) for j in range(dimensions)] for i in range(dimensions)]
    return n, sums, products


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients, lowest first, of det(x - matrix) for a semidefinite integer matrix; the primes are dealt to Spark tasks."""
    primes = primes_for(coefficient_bound(matrix))

    def reduce(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = residues(matrix, batch.column("prime").to_numpy())
        yield pa.record_batch([batch.column("prime"), pa.array(found.tolist(), pa.list_(pa.int64()))], names=["prime", "residues"])

    tasks = -(-len(primes) // PRIMES_PER_TASK)
    frame = spark.range(0, tasks, 1, tasks).select(F.explode(F.get(F.array(*[F.array(*[F.lit(q) for q in primes[t::tasks]]) for t in range(tasks)]), F.col("id").cast("int"))).alias("prime"))
    rows = mapped(frame.select(F.col("prime").cast("long").alias("prime")), reduce, "prime long, residues array<long>").collect()
    return combined([r["prime"] for r in rows], [r["residues"] for r in rows])


def fit(vectors: DataFrame, dimensions: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on distinct integer vectors (column ``x``). Directions without variance are no components; None if there is none."""
    n, shifted, products = sums_of_products(vectors, dimensions)
    scatter = [[n * products[i][j] - shifted[i] * shifted[j] for j in range(dimensions)] for i in range(dimensions)]
    common = gcd(*[v for row in scatter for v in row]) if dimensions else 0
    if not common:
        return None
    matrix = [[v // common for v in row] for row in scatter]
    trace = sum(matrix[i][i] for i in range(dimensions))
    found = largest_roots(characteristic_polynomial(vectors.sparkSession, matrix), components)
    vectors_, values, shares = [], [], []
    for root, times in found:
        for v in null_vectors(matrix, root, times):
            vectors_.append([float(e) for e in v])
            values.append(float(root * common / n**2))
            shares.append(float(root / trace))
    sums = tuple(s + n * SHIFT for s in shifted)
    return Whitening(n, sums, np.array(vectors_[:components]), tuple(values[:components]), tuple(shares[:components]))


def _centred(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """x less its mean, as doubles; n * x less the sums, as integers."""
    shifted = np.array([s - model.n * SHIFT for s in model.sums], dtype=object)
    whole, rest = shifted // model.n, shifted % model.n
    less = x - whole.astype(np.int64)
    centred = less - (rest / model.n).astype(np.float64)
    largest = int(np.abs(less).max(initial=0)) + 1
    if (model.n * largest) ** 2 * x.shape[1] < 1 << 62:
        return centred, model.n * less - rest.astype(np.int64)
    return centred, model.n * less.astype(object) - rest


def _weights(model: Whitening) -> np.ndarray:
    return (model.components / np.sqrt(model.values)[:, None]).T


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """(key, x) to key, deviation and the whitened entries; a deviation beyond 64 bits is null."""
    dimensions = len(model.sums)

    def whiten(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        centred, exact = _centred(_matrix(batch.column("x"), dimensions), model)
        squares = (exact * exact).sum(axis=1)
        if squares.dtype == object:
            squares = [int(s) if s < 1 << 63 else None for s in squares]
        white = centred @ _weights(model)
        out = pa.ListArray.from_arrays(pa.array(np.arange(0, white.size + 1, white.shape[1]), pa.int32()), pa.array(white.ravel()))
        yield pa.record_batch([batch.column("key"), pa.array(squares, pa.int64()), out], names=["key", "deviation", "whitened"])

    return mapped(rows, whiten, "key long, deviation long, whitened array<double>")


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    dimensions, size = len(model.sums), len(model.values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            w = _centred(_matrix(batch.column("x"), dimensions), model)[0] @ _weights(model)
            m, total = len(w), w.sum(axis=0)
            own = w - total / m
            if n:  # joined around the common mean
                apart = total / m - sums / n
                squares += np.outer(apart, apart) * (n * m / (n + m))
            n, sums, squares = n + m, sums + total, squares + own.T @ own
        if n:
            within = squares + np.outer(sums, sums) / n
            cells = np.concatenate([[n], sums, within.ravel()])
            yield pa.record_batch([pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells)], names=["cell", "v"])

    ship(vectors.sparkSession)
    cells = vectors.select("x").mapInArrow(moments, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(1 + size + size * size)
    for r in cells:
        flat[r["cell"]] = r["v"]
    n, sums, within = flat[0], flat[1 : 1 + size], flat[1 + size :].reshape(size, size)
    covariance = (within - np.outer(sums, sums) / n) / n
    return float(np.abs(covariance - np.eye(size)).max())


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable row and component: component (from 1, by falling variance), n, deviation, whitened, explained, identity_error.

    Rows without a vector, or with an entry that is null, not finite or of a size of 2**45 or more, are left out. Shorter vectors are filled up
    with zeros. Repeated vectors count once in the fit, but every row has its result; null keys stay. Directions without variance are not
    returned, so equal vectors, one vector, empty vectors and an empty table have no result. Other columns are not read.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    good = usable(rows, vector)
    dimensions = good.agg(F.max(F.size(vector)).alias("d")).head()["d"] or 0
    if not dimensions:
        return empty_as(OUT, spark)
    held, _ = scratch.store(integer_vectors(rows, key, vector, dimensions), "integers")
    distinct, path = scratch.store(held.select("x").distinct(), "distinct")
    model = fit(distinct, dimensions, components)
    if model is None:
        return empty_as(OUT, spark)
    error = identity_error(distinct, model)
    scratch.drop(path)
    shares = F.array(*[F.lit(s) for s in model.explained])
    out = apply(held, model).select("key", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        F.col("key").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
