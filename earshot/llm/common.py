"""Helpers the operators share: tables between stages, and text as numpy arrays inside tasks.

Texts arrive in tasks as Arrow batches. ``text_chunks`` walks a batch in runs of whole documents of
about ``CHUNK_BYTES`` so that the arrays made from them stay small; a longer document is a run of its own.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from earshot.session import name_local_dir, note_scratch, scratch_path, scratch_tables

CHUNK_BYTES = 1 << 20

# The white space of the word pattern, and odd multipliers of the prefix hashes.
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python may not find it, once for a Spark application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "earshot.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


class Scratch:
    """Tables of one query in the shared folder; ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession):
        name_local_dir(spark)
        ship(spark)
        self.spark = spark

    def store(self, df: DataFrame, label: str) -> tuple[DataFrame, str]:
        path = scratch_path(self.spark, label)
        note_scratch(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, *paths: str) -> None:
        jvm = self.spark._jvm
        for path in paths:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def tidy(self) -> None:
        """Let Spark's cleaner remove the shuffle files of finished stages; references to them go in turns."""
        for _ in range(3):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.4)


def distilled(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, stored; the tables it stored on the way are deleted."""
    scratch = Scratch(spark)
    path = scratch_path(spark, label)
    with scratch_tables(spark):
        df = build()
        df.write.option("compression", "zstd").parquet(path)
        schema = df.schema
    del df
    scratch.tidy()
    return spark.read.schema(schema).parquet(path)


def free_workers(spark: SparkSession) -> None:
    """Have the executors' Python workers, which Spark uses again and again, give back what earlier stages left in them.

    Tables of the encoder and of powers go (they are made anew where needed), and freed memory returns to the system.
    """
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes

        from earshot.llm import common, encoding

        encoding._ENCODERS.clear()
        common._POWERS.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)
        yield from batches

    tasks = 8 * spark.sparkContext.defaultParallelism  # so many that every worker gets one
    spark.range(0, tasks, 1, tasks).mapInArrow(run, "id long").write.format("noop").mode("overwrite").save()


def empty_as(schema: str, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schema)


def mapped(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows; a null text has no bytes."""
    if column.null_count:
        column = column.fill_null(column.type and pa.scalar("", column.type))
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        end = min(end, len(column))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BYTE_BASE))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    held = _POWERS.get(base)
    if held is None or len(held[0]) < n:
        size = n + (n >> 3) + 1024
        out = []
        for factor in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, factor, dtype=np.uint64)
            p[0] = 1
            with np.errstate(over="ignore"):
                out.append(np.multiply.accumulate(p))
        held = (out[0], out[1])
        if size <= 4 * CHUNK_BYTES:
            _POWERS[base] = held
    return held


class PrefixHash:
    """Polynomial hashes of any slice of a sequence of 64-bit values, from one running sum."""

    def __init__(self, values: np.ndarray, base: int):
        up, self.down = powers(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all slices of one size."""
        n = max(0, len(self.sums) - size)
        with np.errstate(over="ignore"):
            return mix((self.sums[size:] - self.sums[:n]) * self.down[:n]) if n else np.zeros(0, np.uint64)


def byte_hash(data: np.ndarray) -> PrefixHash:
    return PrefixHash(_BYTE_VALUES[data], BYTE_BASE)


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BARE = LOWER.copy()
BARE[[b for b in range(33, 127) if not chr(b).isalnum()]] = 32


class Words:
    """The words of a run of documents: byte ranges, hashes, and each document's range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, bare: bool = False):
        """``lower``: A to Z in lower case; ``bare``: also without ASCII marks, which then are white space."""
        if lower or bare:
            data = (BARE if bare else LOWER)[data]
        self.data = data
        solid = ~_IS_SPACE[data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[offsets] = True  # words never run from one document into the next
        before = np.zeros(len(data), dtype=bool)
        before[1:] = solid[:-1]
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = solid[1:]
        self.start = np.flatnonzero(solid & (~before | cut[:-1]))
        self.end = np.flatnonzero(solid & (~after | cut[1:])) + 1
        self.prefix = byte_hash(data)
        self.hash = self.prefix.slices(self.start, self.end)
        self.bounds = np.searchsorted(self.start, offsets)  # words of document i: bounds[i] to bounds[i + 1]

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on; those that leave the document must be left out by the caller."""
        return PrefixHash(self.hash, WORD_BASE).windows(n)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of starts[i], starts[i] + 1, ... with counts[i] members each."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(counts)
    out = np.ones(total, dtype=np.int64)
    full = counts > 0
    first = (ends - counts)[full]
    out[first] = starts[full]
    out[first[1:]] -= starts[full][:-1] + counts[full][:-1] - 1
    return np.cumsum(out)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the place of its smallest, the last one among equals."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    place = np.arange(len(values))
    best, at, span = values, place, 1
    while span * 2 <= width:  # minima of runs of 1, 2, 4, ... values
        left, right = best[:-span], best[span:]
        take = right <= left
        best, at = np.where(take, right, left), np.where(take, at[span:], at[:-span])
        span *= 2
    rest = width - span
    left, right = best[:n], best[rest : rest + n]
    return np.where(right <= left, at[rest : rest + n], at[:n])
