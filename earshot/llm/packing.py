"""Packing documents into training sequences by multiway number differencing.

Every document becomes its ids and an end id. It is cut into whole windows, which fill a sequence alone, and pieces of at most
``PIECE`` ids. Pieces are dealt into groups of about ``GROUP`` by a hash, so no group grows with the input. In a group, the
differencing method of Karmarkar and Karp for several subsets keeps one partial partition per piece and again and again merges
the two with the largest spread, the fullest subset of one with the emptiest of the other, until one partition of nearly equal
windows is left. It starts from the fewest windows that could hold the group; while the fullest window is over its capacity,
the count rises by one (and, after ``TRIES`` tries, by more).
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import Scratch, mapped, text_chunks
from earshot.llm.encoding import encoder

CAPACITY = 2048
END_ID = 1
PIECE = 512
GROUP = 512
TRIES = 4

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Members of each window: a partition of the sizes into ``windows`` subsets of nearly equal sums.

    A partial partition is a pair of arrays: subset sums less the smallest one, ascending, and the subsets' ids, whose
    members are linked by a union of lists kept beside. Ties go to the earlier made partition.
    """
    members: dict[int, list[int]] = {i: [i] for i in range(len(sizes))}
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, dtype=np.int64)
        ids = np.full(windows, -1, dtype=np.int64)
        sums[-1], ids[-1] = size, i
        heap.append((-size if windows > 1 else 0, i, sums, ids))
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, sums, ids = heapq.heappop(heap)
        _, _, other, theirs = heapq.heappop(heap)
        sums = sums + other[::-1]
        theirs = theirs[::-1]
        for k in np.flatnonzero((ids >= 0) & (theirs >= 0)):
            a, b = int(ids[k]), int(theirs[k])
            members[a] = members[a] + members.pop(b)
        ids = np.maximum(ids, np.where(ids >= 0, -1, theirs))
        order = np.argsort(sums, kind="stable")
        sums, ids = sums[order], ids[order]
        spread = int(sums[-1] - sums[0])
        heapq.heappush(heap, (-spread, made, sums - sums[0], ids))
        made += 1
    return [members[int(i)] for i in heap[0][3] if i >= 0] if heap else []


def partition(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``, as few as differencing reaches; sizes are at most the capacity."""
    total = sum(sizes)
    windows, tries = max(1, -(-total // capacity)), 0
    while True:
        made = difference(sizes, windows) if windows < len(sizes) else [[i] for i in range(len(sizes))]
        if all(sum(sizes[i] for i in one) <= capacity for one in made):
            return made
        tries += 1
        windows += 1 if tries < TRIES else max(1, windows // 50)


def cut(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole windows, then even parts of the rest."""
    full = n // capacity
    spans = [(i * capacity, capacity) for i in range(full)]
    rest = n - full * capacity
    if rest:
        parts = -(-rest // piece)
        edges = [full * capacity + rest * i // parts for i in range(parts + 1)]
        spans += [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return spans


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, piece: int = PIECE, end_id: int = END_ID) -> DataFrame:
    end = int(end_id).to_bytes(4, "little")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).chunk
        for first, last, data, offsets in text_chunks(batch.column(1)):
            ids, bounds = encode(data, offsets)
            raw, bounds = ids.astype("<u4").tobytes(), bounds.tolist()
            rows: list[tuple] = []
            for key, a, b in zip(batch.column(0)[first:last].to_pylist(), bounds, bounds[1:], strict=False):
                own = raw[4 * a : 4 * b] + end
                n = b - a + 1
                rows += [(key, at, m, zlib.crc32(own[4 * at : 4 * (at + m)]), n) for at, m in cut(n, capacity, piece)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[x.split()[0] for x in PIECES.split(", ")])

    return mapped(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, PIECES)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, piece: int = PIECE, group: int = GROUP, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its sequence and its offset there.

    A null or empty text is its end id alone. Equal rows are packed each on their own. A null doc_id stays null. An empty
    table has no pieces. Columns besides doc_id and text are not read. Sequence ids are unique, not dense: the group's number
    times 2**32 plus the window's number.
    """
    spark = docs.sparkSession
    cuts, _ = Scratch(spark).store(pieces(docs, path, capacity, piece, end_id), "pieces")
    groups = max(1, -(-cuts.count() // group))
    width = min(groups, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by group; a group may go on in the next batch."""
        held: list[pd.DataFrame] = []
        for batch in batches:
            key = batch["g"].to_numpy()
            edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1), len(batch)]
            for a, b in zip(edges, edges[1:], strict=False):
                if held and a < b and held[0]["g"].iat[0] != key[a]:
                    yield arrange(pd.concat(held))
                    held = []
                if a < b:
                    held.append(batch.iloc[a:b])
        if held:
            yield arrange(pd.concat(held))

    def arrange(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        sizes = rows["length"].tolist()
        full = sum(1 for s in sizes if s == capacity)
        made = [[i] for i in range(full)] + [[full + i for i in one] for one in partition(sizes[full:], capacity)]
        window, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for k, one in enumerate(made):
            at = 0
            for i in sorted(one):
                window[i], offset[i] = k, at
                at += sizes[i]
        rows["sequence_id"] = rows["g"].to_numpy() * (1 << 32) + window
        rows["offset"] = offset
        return rows.drop(columns="g")

    dealt = cuts.withColumn("g", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    return dealt.repartition(width, "g").sortWithinPartitions("g").mapInPandas(place, PLACED)
