"""Removal of byte strings that occur more than once, by sorting suffixes with hashed comparisons.

Suffixes are taken at anchors (``paths.py``): every string of ``LENGTH`` bytes holds one, and equal strings hold it at equal
places, so strings that repeat are found among suffixes of one anchor. Paths that repeat as a whole are found first, by a
combining aggregate; one of each kind stays for comparison with the other paths of its anchor.

The paths left are sorted twice in each bucket of an anchor: by the bytes from the anchor on, and by the bytes before it read
backwards. The sort is a merge sort whose comparisons take the longest common extension of two suffixes from prefix hashes by
binary search, and look at one byte beyond it. All comparisons of a merge step are made together in numpy. Extensions between
neighbours in the final order are then verified byte by byte. Two windows are equal if their parts before and after the anchor
are, that is if they lie in the same run of both orders at the depths that the window has on the two sides.

A bucket of more than ``BUCKET`` paths (say the edge of a passage that very many documents share) is not sorted in one task: its
windows are keyed by their own hashes instead and counted by a combining aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import BYTE_BASE, PrefixHash, Scratch, byte_hash, distilled, mapped, mix, ranges, signed, text_chunks
from earshot.llm.paths import NO_ID, Paths, covered_units, identified, with_texts

LENGTH = 200
ANCHOR = 24
BUCKET = 4096
SORTED_AT_ONCE = 16384

PARTS = "anchor long, doc long, at long, count int, before int, bytes binary"
RUNS = "doc long, at long, count long"
SINGLE = "anchor long, window long, check long, doc long, at long"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def common_extension(hashes: PrefixHash, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Longest common prefix of the suffixes at a and b, at most ``most``, by binary search over prefix hashes."""
    low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) >> 1
        same = hashes.slices(a, a + middle) == hashes.slices(b, b + middle)
        low = np.where(open_ & same, middle, low)
        high = np.where(open_ & ~same, middle - 1, high)


class Suffixes:
    """Suffixes of a byte array, each of a bucket and of a limited length, in hashed-comparison order."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, bucket: np.ndarray):
        self.data = np.concatenate([data, np.zeros(1, np.uint8)])
        self.start, self.length = start, length
        self.hashes = byte_hash(data)
        self.order = self._sorted(bucket)
        self.shared = self._verified(bucket)

    def _compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0, 1 as suffix a is before, like or after suffix b."""
        most = np.minimum(self.length[a], self.length[b])
        shared = common_extension(self.hashes, self.start[a], self.start[b], most)
        x = np.where(shared < self.length[a], self.data[self.start[a] + np.minimum(shared, self.length[a])].astype(np.int64), -1)
        y = np.where(shared < self.length[b], self.data[self.start[b] + np.minimum(shared, self.length[b])].astype(np.int64), -1)
        return np.sign(x - y)

    def _sorted(self, bucket: np.ndarray) -> np.ndarray:
        """Bottom-up merge sort inside every bucket; buckets are contiguous."""
        n = len(bucket)
        order = np.arange(n)
        if not n:
            return order
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        size = np.diff(np.append(edge, n))
        base, whole = np.repeat(edge, size), np.repeat(size, size)
        place = np.arange(n) - base
        run = 1
        while run < size.max():
            live = np.flatnonzero(whole > run)
            mine = place[live] // run
            other = base[live] + (mine ^ 1) * run
            room = np.clip(base[live] + whole[live] - other, 0, run)
            left = (mine & 1) == 0
            low, high = np.zeros(len(live), np.int64), room.copy()
            while True:  # how many of the neighbouring run come before this suffix
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                sign = self._compare(order[other[open_] + middle], order[live[open_]])
                ahead = (sign < 0) | ((sign == 0) & ~left[open_])
                low[open_] = np.where(ahead, middle + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], middle)
            target = base[live] + (mine >> 1) * 2 * run + place[live] % run + low
            merged = order.copy()
            merged[target] = order[live]
            order = merged
            run *= 2
        return order

    def _verified(self, bucket: np.ndarray) -> np.ndarray:
        """Bytes that a suffix shares with the one before it in the order; -1 at a bucket's start. Read, not hashed."""
        a, b = self.order[:-1], self.order[1:]
        shared = common_extension(self.hashes, self.start[a], self.start[b], np.minimum(self.length[a], self.length[b]))
        for at in range(0, len(shared), 4096):
            part = slice(at, at + 4096)
            step = np.arange(int(shared[part].max(initial=0)))
            if not len(step):
                continue
            top = len(self.data) - 1
            x = self.data[np.minimum(self.start[a[part], None] + step, top)]
            y = self.data[np.minimum(self.start[b[part], None] + step, top)]
            unlike = (x != y) & (step < shared[part, None])
            shared[part] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), shared[part])
        return np.concatenate([[-1], np.where(bucket[a] == bucket[b], shared, -1)])[: len(bucket)]

    def classes(self, depth: int) -> np.ndarray:
        """A number for each suffix, the same for those of a bucket that share ``depth`` bytes."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.cumsum(self.shared < depth)
        return out


def repeated_windows(data: np.ndarray, offsets: np.ndarray, before: np.ndarray, count: np.ndarray, bucket: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, window) of all windows that occur in another row of the bucket. Row i has the bytes of ``count`` windows,
    its anchor ``before`` bytes from the first."""
    begin, end = offsets[:-1], offsets[1:]
    right = Suffixes(data, begin + before, end - begin - before, bucket)
    back = len(data) - (begin + before)  # the same place in the array read backwards
    left = Suffixes(data[::-1], back, before.astype(np.int64), bucket)
    rows, windows = [], []
    for depth in range(int(before.max(initial=0)) + 1):  # bytes before the anchor
        first = before - depth  # the window's number in its row
        live = np.flatnonzero((first >= 0) & (first < count))
        if len(live) < 2:
            continue
        pair = left.classes(depth)[live] * (len(bucket) + 1) + right.classes(length - depth)[live]
        order = np.argsort(pair, kind="stable")
        same = pair[order][1:] == pair[order][:-1]
        hit = np.zeros(len(live), bool)
        hit[order[1:]] |= same
        hit[order[:-1]] |= same
        rows.append(live[hit])
        windows.append(first[live[hit]])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(windows).astype(np.int64)


def parts(docs: DataFrame, paths: DataFrame, graph: Paths) -> DataFrame:
    """The bytes of some paths (doc, at, anchor, shape), cut from the texts."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, last, data, offsets in text_chunks(batch.column(2)):
            own = batch.column(3).slice(first, last - first)
            flat = own.flatten()
            doc = np.repeat(np.arange(last - first), [len(x) for x in own])
            shape = flat.field("shape").to_numpy(zero_copy_only=False).astype(np.int64)
            count, before = shape & 0xFFFF, shape >> 16
            start = flat.field("first").to_numpy(zero_copy_only=False).astype(np.int64)
            raw, at = data.tobytes(), (start + offsets[:-1][doc]).tolist()
            cut = [raw[a : a + n - 1 + graph.window] for a, n in zip(at, count.tolist(), strict=True)]
            rows = pa.array(doc + first)
            digest = batch.column(1).take(rows).to_numpy()
            columns = [flat.field("anchor"), batch.column(0).take(rows), pa.array((digest << 32) | start), pa.array(count.astype(np.int32)), pa.array(before.astype(np.int32)), pa.array(cut, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PARTS.split(", ")])

    return mapped(with_texts(docs, paths), run, PARTS)


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in column.to_pylist()], np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def _runs(doc: np.ndarray, at: np.ndarray, row: np.ndarray, window: np.ndarray) -> pa.RecordBatch:
    """Hits as runs of windows that follow one another."""
    order = np.lexsort((window, row))
    row, window = row[order], window[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(row)))
    return pa.RecordBatch.from_arrays([pa.array(doc[row[first]]), pa.array(at[row[first]] + window[first]), pa.array(count)], names=["doc", "at", "count"])


def sorted_buckets(rows: DataFrame, length: int) -> DataFrame:
    """Repeated windows by suffix sorting; buckets of an anchor come whole into one task, many at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= SORTED_AT_ONCE:
                whole = pa.concat_tables(held)
                anchors = whole.column("anchor").to_numpy()
                edge = int(np.searchsorted(anchors, anchors[-1]))  # the last bucket may go on
                if edge:
                    yield from one(whole.slice(0, edge))
                    whole = whole.slice(edge)
                held, size = [whole], whole.num_rows
        if size:
            yield from one(pa.concat_tables(held))

    def one(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        at = 0
        anchors = rows.column("anchor").to_numpy()
        while at < rows.num_rows:  # whole buckets, about SORTED_AT_ONCE rows at a time
            end = min(at + SORTED_AT_ONCE, rows.num_rows)
            end = rows.num_rows if end == rows.num_rows else max(int(np.searchsorted(anchors, anchors[end])), int(np.searchsorted(anchors, anchors[at], "right")))
            part = rows.slice(at, end - at).combine_chunks()
            data, offsets = _joined(part.column("bytes").combine_chunks())
            before, count = (part.column(c).to_numpy().astype(np.int64) for c in ("before", "count"))
            row, window = repeated_windows(data, offsets, before, count, part.column("anchor").to_numpy(), length)
            if len(row):
                yield _runs(part.column("doc").to_numpy(), part.column("at").to_numpy(), row, window)
            at = end

    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, "anchor").sortWithinPartitions("anchor").mapInArrow(run, RUNS)


def counted_buckets(rows: DataFrame, length: int) -> DataFrame:
    """Repeated windows of oversized buckets by counting windows, with two independent hashes as their key."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = _joined(batch.column(5))
        count = batch.column(3).to_numpy().astype(np.int64)
        start = ranges(offsets[:-1], count)
        row = np.repeat(np.arange(len(count)), count)
        one = byte_hash(data).slices(start, start + length)
        two = PrefixHash(mix(data.astype(np.uint64) + np.uint64(BYTE_BASE >> 7)), 0xA0761D6478BD642F).slices(start, start + length)
        rows = pa.array(row)
        at = batch.column(2).take(rows).to_numpy() + start - offsets[:-1][row]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(signed(one)), pa.array(signed(two)), batch.column(1).take(rows), pa.array(at)], names=["anchor", "window", "check", "doc", "at"])

    single = mapped(rows, run, SINGLE)
    key = ["anchor", "window", "check"]
    again = single.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again, _ = Scratch(rows.sparkSession).store(again, "again")
    return single.join(again, key).select("doc", "at", F.lit(1).cast("long").alias("count"))


def repeated(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, bucket: int = BUCKET) -> DataFrame:
    """Runs of windows that occur again anywhere: (doc, at, count), ``at`` being document hash and first byte."""
    graph = Paths(length, anchor, words=False)
    scratch = Scratch(docs.sparkSession)
    paths, _ = scratch.store(graph.candidates(docs, by_order=False), "paths")
    scratch.tidy()
    kinds = paths.groupBy("anchor", "path").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "at", "shape")).alias("keep"))
    kinds, _ = scratch.store(kinds, "kinds")
    whole = kinds.where("copies > 1").select(F.col("anchor").alias("of"), F.col("path").alias("like"))
    again = paths.join(whole, (F.col("anchor") == F.col("of")) & (F.col("path") == F.col("like"))).select("doc", "at", F.col("shape").bitwiseAND(F.lit(0xFFFF)).cast("long").alias("count"))
    # one path of each kind, under anchors with several kinds
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    one = kinds.join(several, "anchor").select("keep.doc", "keep.at", "anchor", "keep.shape")
    cut, _ = scratch.store(parts(docs, one, graph), "parts")
    scratch.tidy()
    sizes = cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    large, _ = scratch.store(sizes.where(F.col("n") > bucket).select("anchor"), "large")  # stored, so that joins with it can be split
    small = sorted_buckets(cut.join(large, "anchor", "left_anti").select(*cut.columns), length)
    return again.unionByName(small).unionByName(counted_buckets(cut.join(large, "anchor").select(*cut.columns), length))


def dedup(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, bucket: int = BUCKET) -> DataFrame:
    """Per row doc_id, n_bytes, n_removed, n_spans and the kept bytes.

    A null text has no bytes. Every row is a document of its own: repeated rows of ``length`` bytes or more cover one another
    whole, also if their ids are equal or null. Shorter texts keep all. Kept bytes need not be valid UTF-8.
    """
    runs = distilled(docs.sparkSession, "runs", lambda: repeated(docs, length, anchor, bucket))
    grouped = runs.select("doc", F.shiftright("at", 32).alias("digest"), F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).alias("first"), "count")
    grouped = grouped.groupBy("doc", "digest").agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    rows = identified(docs).join(grouped, ["doc", "digest"], "left").select("doc", "text", "runs")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for begin, end, data, offsets in text_chunks(batch.column(1)):
            runs = batch.column(2).slice(begin, end - begin)
            removed, spans, kept = [], [], []
            for i in range(end - begin):
                own = data[offsets[i] : offsets[i + 1]]
                found = runs[i].values
                gone = np.zeros(len(own), bool)
                if found is not None and len(found):
                    gone = covered_units(len(own), found.field("first").to_numpy(zero_copy_only=False), found.field("count").to_numpy(zero_copy_only=False), length)
                removed.append(int(gone.sum()))
                spans.append(int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(gone) else 0)))
                kept.append(own[~gone].tobytes())
            ids = batch.column(0).slice(begin, end - begin).to_numpy()
            columns = [pa.array(ids, mask=ids == NO_ID), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return mapped(rows, run, RESULT)
