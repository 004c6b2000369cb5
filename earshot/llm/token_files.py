"""Token files compressed with a grammar of repeated pairs (Re-Pair), and random access to their documents.

Documents are put in ascending doc_id order by a range partitioning; each partition writes shards of about ``SHARD`` ids, a
document whole in one shard. In a shard, rounds replace frequent pairs of neighbouring ids by new ids (nonterminals) until no pair
occurs ``LEAST`` times; all pairs are counted, each round takes up to ``PER_ROUND`` of the pairs that then are most frequent, and of
occurrences that overlap those of the more frequent pair. A shard file row holds the
rules, the length every rule expands to, the last sequence, and where each document starts in the original ids. The expansion
lengths give the place of any original id in the sequence, so one document is decoded without the others.

A document whose ids start and end inside a nonterminal would need no care, because rules never join ids across the end of a
document: the end id is in no pair.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import Scratch, ship, text_chunks
from earshot.llm.encoding import encoder

END_ID = 2
SHARD = 1 << 19
PER_ROUND = 8192
LEAST = 2
FIRST_NEW = 1 << 17  # nonterminals start beyond every vocabulary that the files are written for

SHARDS = "range long, shard long, n_ids long, doc_ids binary, doc_sizes binary, rules binary, lengths binary, symbols binary"
TOKENS = "doc_id long, range long, shard long, start_in_shard long, n_tokens long, ids_crc32 long"

_BITS = 18
_FEW = 1 << 14  # so few pairs are sorted as they are


def _pair_codes(left: np.ndarray, right: np.ndarray, at: np.ndarray, barrier: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the pairs of neighbours that start at places in ascending order; which ones hold no barrier; which of these count.

    In a run of one id only every second pair counts, as those between overlap them.
    """
    codes = left.astype(np.uint64)
    codes <<= np.uint64(32)
    codes |= right
    inside = (left != barrier) & (right != barrier)
    same = np.flatnonzero(left == right)
    if not len(same):
        return codes, inside, inside
    counts = inside.copy()
    first = np.diff(at[same], prepend=-2) > 1
    place = np.arange(len(same))
    counts[same[(place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 1]] = False
    return codes, inside, counts


def _frequent(codes: np.ndarray, most: int, least: int) -> np.ndarray:
    """The most frequent pair codes of those that occur ``least`` times, most frequent first; every pair is counted."""
    seen = np.sort(codes)
    starts = np.flatnonzero(np.concatenate([[True], seen[1:] != seen[:-1]])[: len(seen)])
    counts = np.diff(starts, append=len(seen))
    keep = counts >= least
    pairs, counts = seen[starts[keep]], counts[keep]
    if len(pairs) > most:
        keep = counts >= np.partition(counts, -most)[-most]
        pairs, counts = pairs[keep], counts[keep]
    return pairs[np.argsort(-counts, kind="stable")[:most]]  # equally frequent ones by their codes


def _slots(codes: np.ndarray, turn: int) -> np.ndarray:
    """Slots of pair codes, others in each round, so that pairs that share one part."""
    mixed = codes * np.uint64(0x9E3779B97F4A7C15 * (2 * turn + 1) & 0xFFFFFFFFFFFFFFFF)
    mixed >>= np.uint64(64 - _BITS)
    return mixed.view(np.int64)


def compress(ids: np.ndarray, barrier: int, rounds: int | None = None, per_round: int = PER_ROUND, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules: left, right of each nonterminal; expansion lengths; the sequence left).

    Without ``rounds`` they go on until no pair occurs ``least`` times; each one makes the sequence shorter. A pair that occurs less
    often never gets more frequent, so later rounds look only at places that are still open: those of pairs that may be frequent, and
    those beside a new id.
    """
    seq = ids.astype(np.uint32)
    rules, lengths = [np.zeros((0, 2), np.uint32)], [np.zeros(0, np.uint32)]
    open_at = np.ones(len(seq), dtype=bool)
    rank = np.full(len(seq) + 2, per_round, np.int32)  # of the pair at each place, one on
    slots = np.zeros(1 << _BITS, np.int32)
    made, done = 0, 0
    while rounds is None or done < rounds:
        place = np.flatnonzero(open_at[:-1])
        left, right = (seq[place], seq[place + 1]) if done else (seq[:-1], seq[1:])
        codes, inside, counts = _pair_codes(left, right, place, barrier)
        open_at[place[~inside]] = False
        place, codes = place[counts], codes[counts]
        slots_of = _slots(codes, done)
        if done and len(codes) > _FEW:  # a frequent pair's slot is frequent too; at first nearly all are
            held = (np.bincount(slots_of, minlength=1 << _BITS) >= least)[slots_of]
            open_at[place[~held]] = False
            place, codes, slots_of = place[held], codes[held], slots_of[held]
        pairs = _frequent(codes, per_round, least)
        if not len(pairs):
            break
        slots_of_pairs = _slots(pairs, done)
        slots[slots_of_pairs[::-1]] = np.arange(len(pairs))[::-1]  # of pairs that share a slot the most frequent one stays, the others wait for a round
        listed = np.full(per_round, 0xFFFFFFFFFFFFFFFF, np.uint64)
        listed[: len(pairs)] = pairs
        own = slots[slots_of]
        hit = listed[own] == codes
        place, own = place[hit], own[hit]
        # of places that overlap the more frequent pair's counts, so the most frequent pair has all of its own
        rank[place + 1] = own
        beats = (own < rank[place]) & (own < rank[place + 2])
        rank[place + 1] = per_round
        where, own = place[beats], own[beats]
        used = np.bincount(own, minlength=len(pairs)) >= least  # the others wait for a round
        if not used.all():
            where, own = where[used[own]], own[used[own]]
        number, pairs = np.cumsum(used) - 1, pairs[used]
        new = np.stack([(pairs >> np.uint64(32)), pairs & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
        known = np.concatenate(lengths)
        size = np.ones(new.shape, np.uint32)
        inner = new >= FIRST_NEW
        size[inner] = known[new[inner] - FIRST_NEW]
        lengths.append(size.sum(axis=1).astype(np.uint32))
        rules.append(new)
        seq[where] = (FIRST_NEW + made + number[own]).astype(np.uint32)
        open_at[where] = open_at[where[where > 0] - 1] = True
        stays = np.ones(len(seq), dtype=bool)
        stays[where + 1] = False
        seq, open_at = seq[stays], open_at[stays]
        made, done = made + len(pairs), done + 1
    return np.concatenate(rules), np.concatenate(lengths), seq


def expand(seq: np.ndarray, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids that a part of a shard's sequence stands for; every symbol on the way is looked at once."""
    spans = _spans(seq, lengths)
    out = np.empty(spans.sum(), seq.dtype)
    at = np.cumsum(spans) - spans
    while len(seq):
        inner = seq >= FIRST_NEW
        out[at[~inner]] = seq[~inner]
        pairs, at = rules[seq[inner] - FIRST_NEW], at[inner]
        seq, at = pairs.T.ravel(), np.concatenate([at, at + _spans(pairs[:, 0], lengths)])
    return out


def read_document(shard: dict, index: int) -> np.ndarray:
    """Ids of one document of a shard row, decoding only the symbols that hold it."""
    sizes = np.frombuffer(shard["doc_sizes"], "<i8")
    rules, lengths = np.frombuffer(shard["rules"], "<u4").reshape(-1, 2), np.frombuffer(shard["lengths"], "<u4")
    seq = np.frombuffer(shard["symbols"], "<u4")
    ends = np.cumsum(_spans(seq, lengths))
    start = int(sizes[:index].sum())
    a, b = np.searchsorted(ends, [start, start + int(sizes[index])], "right")
    b = int(np.searchsorted(ends, start + int(sizes[index]), "left")) + 1
    first = int(ends[a - 1]) if a else 0
    return expand(seq[a:b], rules, lengths)[start - first : start - first + int(sizes[index])]


def _spans(seq: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.ones(len(seq), np.int64)
    inner = seq >= FIRST_NEW
    out[inner] = lengths[seq[inner] - FIRST_NEW]
    return out


def write(docs: DataFrame, out: str, path: str, partitions: int, end_id: int = END_ID, shard_ids: int = SHARD) -> None:
    """Write shards of all documents, ordered by doc_id (nulls first; equal ids in the order of their texts), to a folder.

    A null or empty text is its end id alone. Columns besides doc_id and text are not read. An empty table writes no shard.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path).chunk, TaskContext.get().partitionId()
        keys: list = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        size, shard = 0, 0
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column(1)):
                ids, bounds = encode(data, offsets)
                held.append(np.insert(ids, bounds[1:], end_id))  # the end id after each document's ids
                sizes.append(np.diff(bounds) + 1)
                keys += batch.column(0)[first:last].to_pylist()
                size += len(held[-1])
                if size >= shard_ids:
                    yield one(part, shard, keys, held, sizes)
                    keys, held, sizes, size, shard = [], [], [], 0, shard + 1
        if held:
            yield one(part, shard, keys, held, sizes)

    def one(part: int, shard: int, doc_ids: list, held: list, counts: list) -> pa.RecordBatch:
        ids = np.concatenate(held)
        rules, lengths, seq = compress(ids, end_id)
        null = np.iinfo(np.int64).min
        keys = np.array([null if k is None else k for k in doc_ids], "<i8")
        sizes = np.concatenate(counts).astype("<i8")
        row = [[part], [shard], [len(ids)], [keys.tobytes()], [sizes.tobytes()], [rules.astype("<u4").tobytes()], [lengths.astype("<u4").tobytes()], [seq.astype("<u4").tobytes()]]
        kinds = [pa.int64()] * 3 + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in SHARDS.split(", ")])

    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SHARDS).write.option("compression", "zstd").parquet(out)


def read(spark, out: str) -> DataFrame:
    """Decode every document of a folder of shards: its place among all ids, its length and the checksum of its ids."""
    ship(spark)
    shards = spark.read.schema(SHARDS).parquet(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                got = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
                rules, lengths = np.frombuffer(got["rules"], "<u4").reshape(-1, 2), np.frombuffer(got["lengths"], "<u4")
                ids = expand(np.frombuffer(got["symbols"], "<u4"), rules, lengths).astype("<u4")
                sizes, keys = np.frombuffer(got["doc_sizes"], "<i8"), np.frombuffer(got["doc_ids"], "<i8")
                starts = np.cumsum(sizes) - sizes
                whole = ids.tobytes()
                crc = [zlib.crc32(whole[4 * a : 4 * (a + n)]) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                n = len(sizes)
                columns = [pa.array(keys, mask=keys == np.iinfo(np.int64).min), pa.array(np.full(n, got["range"])), pa.array(np.full(n, got["shard"])), pa.array(starts), pa.array(sizes), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in TOKENS.split(", ")])

    # One row per shard, then one per range: sums over few rows place each shard among all ids.
    sizes = shards.select("range", "shard", "n_ids")
    before = Window.partitionBy("range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    within = sizes.withColumn("in_range", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    totals = sizes.groupBy("range").agg(F.sum("n_ids").alias("n"))
    ahead = totals.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    place = within.join(ahead, "range").select("range", "shard", (F.col("in_range") + F.col("ahead")).alias("base"))
    decoded = shards.mapInArrow(run, TOKENS)
    return decoded.join(place, ["range", "shard"]).select(
        "doc_id", (F.col("base") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, path: str, end_id: int = END_ID, shard_ids: int = SHARD) -> DataFrame:
    """Write all documents as shards under the shared folder and read them back."""
    from earshot.session import scratch_path

    spark = docs.sparkSession
    scratch = Scratch(spark)
    out = scratch_path(spark, "tokens")
    write(docs, out, path, int(spark.conf.get("spark.sql.shuffle.partitions")), end_id, shard_ids)
    scratch.tidy()
    return read(spark, out)
