"""Hard-negative mining by segment summaries.

Vectors become integers, ``floor(SCALE * entry)``; a score is an integer inner product. A vector is cut into segments of equal length,
and of each segment its sum and its deviation (the length of what is left when the mean is taken off) are stored, at several lengths.
For two vectors, the means' products (sum times sum, over the segment's length) added up over segments, plus or minus the products of the
deviations, bound the score. Pairs are held against coarse segments first; only pairs whose bounds reach into a wanted range are held
against finer ones, and only those still open are scored exactly. Bounds are safe, so the result is that of scoring every pair.

Anchors are a stated set of rows that is held against all rows. Anchors are dealt into shards of about ``SHARD`` rows; a shard (its
vectors and summaries, some 20 MB for 64 dimensions) is broadcast, and each task runs through its rows once, keeping per anchor and
wanted range only the best ``take`` rows so far. The worst of these is the next bound. Tasks' best rows are merged by a window over at most
``take`` rows per task, anchor and range, so no key gathers more than that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import Scratch, empty_as, ship

SCALE = 256
# Segment lengths, coarse to fine; each divides the one before it.
SEGMENTS = (16, 4, 2)
SHARD = 16_384
ROWS_AT_ONCE, ANCHORS_AT_ONCE = 4096, 256
# A share of open pairs under which they are scored one by one instead of as a matrix product.
FEW = 0.03
POSITIVES, NEGATIVES = 5, 10
# Entries from this on count as not finite: scores of 64 bits need bounded entries.
LARGEST = float(1 << 20)
NONE = np.iinfo(np.int64).min
ANY = np.iinfo(np.int64).max


@dataclass
class Block:
    """Rows as arrays: identity, class, integer vectors, and per segment length the sums and deviations."""

    row: np.ndarray
    label: np.ndarray
    x: np.ndarray
    sums: list[np.ndarray]
    spread: list[np.ndarray]

    def take(self, at: np.ndarray | slice) -> Block:
        return Block(self.row[at], self.label[at], self.x[at], [s[at] for s in self.sums], [s[at] for s in self.spread])


def summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and deviations of all segments, lengths one after the other; deviations are rounded up."""
    sums, spread = [], []
    for length in SEGMENTS:
        cut = x.reshape(len(x), -1, length)
        s = cut.sum(axis=2)
        left = (cut * cut).sum(axis=2) - s * s / length
        sums.append(s)
        spread.append(np.sqrt(np.maximum(left, 0.0)) * (1 + 1e-6) + 1e-6)
    return np.concatenate(sums, axis=1), np.nextafter(np.concatenate(spread, axis=1).astype(np.float32), np.float32(np.inf))


def numbered(rows: DataFrame, key: str, vector: str, label: str, dimensions: int) -> DataFrame:
    """Usable rows with a number of their own, integer vectors and summaries; to be stored, as numbers depend on the run."""
    entries = F.col(vector).cast("array<double>")
    filled = F.concat(entries, F.array_repeat(F.lit(0.0), F.lit(dimensions) - F.size(entries)))
    good = usable(rows, vector, label).select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), filled.alias("v"))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.floor(SCALE * batch.column("v").flatten().to_numpy(zero_copy_only=False)).astype(np.int64).reshape(-1, dimensions)
            sums, spread = summaries(x)
            lists = lambda m, kind: pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1]), pa.int32()), pa.array(m.ravel(), kind))
            yield pa.record_batch([batch.column("row"), batch.column("key"), batch.column("label"), lists(x, pa.int32()), lists(sums, pa.int64()), lists(spread, pa.float32())], names=["row", "key", "label", "x", "sums", "spread"])

    ship(rows.sparkSession)
    return good.mapInArrow(convert, "row long, key long, label long, x array<int>, sums array<long>, spread array<float>")


def usable(rows: DataFrame, vector: str, label: str) -> DataFrame:
    """Rows with a label and a vector of finite entries."""
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) >= LARGEST)
    return rows.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & ~F.coalesce(F.exists(F.col(vector).cast("array<double>"), bad), F.lit(True)))


def block(batch: pa.RecordBatch | pa.Table) -> Block:
    flat = lambda name: np.asarray(pa.concat_arrays(batch.column(name).chunks).flatten() if isinstance(batch, pa.Table) else batch.column(name).flatten())
    column = lambda name: np.asarray(batch.column(name))
    n = batch.num_rows
    x = flat("x").astype(np.int64).reshape(n, -1)
    sums, spread = flat("sums").reshape(n, -1), flat("spread").astype(np.float64).reshape(n, -1)
    ends = np.cumsum([x.shape[1] // length for length in SEGMENTS])
    return Block(column("row"), column("label"), x, np.split(sums.astype(np.float64), ends[:-1], axis=1), np.split(spread, ends[:-1], axis=1))


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products of all pairs, as 64-bit integers."""
    if int(np.abs(rows).max(initial=0)) * int(np.abs(anchors).max(initial=0)) * rows.shape[1] < 1 << 53:
        return np.rint(rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    return rows @ anchors.T


def bounds(rows: Block, anchors: Block, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Middle and reach: every pair's score is within middle - reach and middle + reach."""
    middle = rows.sums[level] @ anchors.sums[level].T / SEGMENTS[level]
    reach = rows.spread[level] @ anchors.spread[level].T
    return middle, reach + (1.0 + 1e-12 * np.abs(middle))


def candidates(rows: Block, anchors: Block, wanted, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, score) of all pairs that may count: classes as asked, scores in a range of ``wanted`` (lists of low, high)."""
    low, high = wanted
    equal = rows.label[:, None] == anchors.label[None, :]
    open_pairs = equal if same else ~equal
    if same:
        open_pairs &= rows.row[:, None] != anchors.row[None, :]
    at = np.arange(len(rows.row))
    for level in range(len(SEGMENTS)):
        if not open_pairs.any():
            break
        middle, reach = bounds(rows, anchors, level)
        top, bottom = middle + reach, middle - reach
        inside = np.zeros_like(open_pairs)
        for lo, hi in zip(low, high):
            inside |= (top >= lo) & (bottom <= hi)
        open_pairs &= inside
        keep = open_pairs.any(axis=1)
        if not keep.all():
            rows, open_pairs, at = rows.take(keep), open_pairs[keep], at[keep]
    i, j = np.nonzero(open_pairs)
    if len(i) < FEW * max(open_pairs.size, 1):
        score = np.einsum("ij,ij->i", rows.x[i], anchors.x[j])
    else:
        score = products(rows.x, anchors.x)[i, j]
    return at[i], j, score


class Best:
    """The best ``take`` rows of each slot (an anchor and one of its ranges), by score, then key, then row."""

    def __init__(self, slots: int, take: int):
        self.slots, self.most = slots, take
        self.held = [np.zeros(0, np.int64) for _ in range(5)]  # slot, score, whether the key is missing, key, row
        self.floor = np.full(slots, NONE)
        self.waiting: list[list[np.ndarray]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> None:
        self.waiting.append(list(columns))
        self.size += len(columns[0])
        if self.size > 50_000 + len(self.held[0]):
            self.settle()

    def settle(self) -> None:
        slot, score, missing, key, row = (np.concatenate(parts) for parts in zip(self.held, *self.waiting))
        order = np.lexsort((row, key, missing, -score, slot))
        slot = slot[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = order[place < self.most]
        self.held = [c[kept] for c in (np.concatenate(parts) for parts in zip(self.held, *self.waiting))]
        last = order[place == self.most - 1]
        self.floor[slot[place == self.most - 1]] = score[last]
        self.waiting, self.size = [], 0


def scan(rows: DataFrame, held, count: int, take: int, same: bool) -> DataFrame:
    """(anchor, part, row, key, score): each task's best rows of every anchor and range.

    ``held`` is the broadcast of the anchors and of two (anchors, count) arrays, the ranges' low and high ends.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, low, high = held.value
        best = Best(len(known.row) * count, take)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                mine, key = block(part), part.column("key")
                missing, keys = np.asarray(key.is_null()).astype(np.int64), np.asarray(key.fill_null(0))
                for first in range(0, len(known.row), ANCHORS_AT_ONCE):
                    some = slice(first, first + ANCHORS_AT_ONCE)
                    floor = best.floor.reshape(-1, count)[some]
                    lows, highs = np.maximum(low[some], floor), high[some]
                    i, j, score = candidates(mine, known.take(some), (lows.T, highs.T), same)
                    for k in range(count):
                        hit = np.flatnonzero((score >= lows[j, k]) & (score <= highs[j, k]))
                        if len(hit):
                            best.add((first + j[hit]) * count + k, score[hit], missing[i[hit]], keys[i[hit]], mine.row[i[hit]])
        best.settle() if best.waiting else None
        slot, score, missing, key, row = best.held
        if len(slot):
            yield pa.record_batch([pa.array(known.row[slot // count]), pa.array((slot % count).astype(np.int32)), pa.array(row), pa.array(key, mask=missing.astype(bool)), pa.array(score)], names=["anchor", "part", "row", "key", "score"])

    return rows.select("row", "key", "label", "x", "sums", "spread").mapInArrow(search, "anchor long, part int, row long, key long, score long")


def first(found: DataFrame, take: int) -> DataFrame:
    """The first ``take`` rows of each anchor and range, with their rank from 1."""
    order = Window.partitionBy("anchor", "part").orderBy(F.desc("score"), F.asc_nulls_last("key"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= take)


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, anchor, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = 30, most: int = 90) -> DataFrame:
    """Per anchor and positive the first negatives with least * positive <= 100 * negative <= most * positive, as scores.

    ``anchor`` is a condition on the rows (null is no). A row without label or vector, or with an entry that is null, not finite or of a size of
    2**20 or more, takes no part. Shorter vectors are filled up with zeros. Rows are told apart by themselves: rows equal in all columns
    are each other's positives. Equal scores go by key, missing keys last, then by position. A positive without negatives has no
    row, nor has a table without rows, vectors or anchors. Other columns are not read.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    dimensions = usable(rows, vector, label).agg(F.max(F.size(vector)).alias("d")).head()["d"] or 0
    if not dimensions:
        return empty_as(OUT, spark)
    dimensions = -(-dimensions // SEGMENTS[0]) * SEGMENTS[0]
    held, _ = scratch.store(numbered(rows, key, vector, label, dimensions), "summaries")
    asked, _ = scratch.store(held.where(anchor(F.col("key"))).withColumn("shard", F.xxhash64("row")), "anchors")
    shards = -(-asked.count() // SHARD)
    if not shards:
        return empty_as(OUT, spark)
    out = None
    for shard in range(shards):
        part = asked.where(F.pmod("shard", F.lit(shards)) == shard).drop("shard").toArrow()
        if not part.num_rows:
            continue
        found = _shard(scratch, held, block(part.combine_chunks()), positives, negatives, least, most)
        out = found if out is None else out.unionByName(found)
    names = asked.select(F.col("row").alias("anchor"), F.col("key").alias("anchor_id"))
    return out.join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def best_rows(scratch: Scratch, rows: DataFrame, anchors: Block, ranges: tuple[np.ndarray, np.ndarray], take: int, same: bool, label: str) -> DataFrame:
    """The first ``take`` rows of each anchor and range, stored; the broadcast goes as soon as they are."""
    held = rows.sparkSession.sparkContext.broadcast((anchors, *ranges))
    found, _ = scratch.store(first(scan(rows, held, ranges[0].shape[1], take, same), take), label)
    held.destroy()
    return found


def _shard(scratch: Scratch, held: DataFrame, anchors: Block, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    """The result for one shard of anchors, stored, by their row numbers."""
    whole = (np.full((len(anchors.row), 1), NONE), np.full((len(anchors.row), 1), ANY))
    near = best_rows(scratch, held, anchors, whole, positives, True, "positives")
    place = {int(r): i for i, r in enumerate(anchors.row)}
    low, high = np.full((len(anchors.row), positives), ANY), np.full((len(anchors.row), positives), NONE)
    # A shard's positives are a bounded list; a range without a positive, or of a negative score, stays empty.
    for r in near.select("anchor", "rank", "score").toArrow().to_pylist():
        low[place[r["anchor"]], r["rank"] - 1] = -(-least * r["score"] // 100)
        high[place[r["anchor"]], r["rank"] - 1] = most * r["score"] // 100
    far = best_rows(scratch, held, anchors, (low, high), negatives, False, "negatives")
    one = near.select("anchor", (F.col("rank") - 1).alias("part"), F.col("key").alias("positive_id"), F.col("score").alias("positive_score"))
    other = far.select("anchor", "part", "rank", F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
    return one.join(other, ["anchor", "part"]).drop("part")


def with_moved_labels(rows: DataFrame) -> DataFrame:
    """The query's labels: every seventh row's label moves on by one."""
    return rows.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))


def is_anchor(key):
    return key % 100 == 0


ORACLE = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER pair AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW pair AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER pair <= 10"""
