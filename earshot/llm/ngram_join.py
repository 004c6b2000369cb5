"""Similarity join of documents on their word shingles, by parity sketches.

A document's set has its distinct runs of ``SHINGLE`` words (lower case for A to Z). Documents with equal sets are one node. Two
nodes are linked if their sets have a Jaccard similarity of ``PERCENT`` / 100 or more; then sets of x and y members differ in at
most (x + y) / 9 members (for 80), and neither is over 1.25 times the other.

Sketches. Shingles are dealt by hash into buckets, and a bucket's value is the exclusive or (the parity, bit by bit) of its
shingles' hashes: a member that only one set has changes one bucket. So of two linked sets with a difference of at most d, any
d + 1 buckets of the one include one that has the same value in the other (pigeonholes). A node joins by its first d + 1 buckets
of two or more shingles, in the order of buckets; if it has fewer, by all that are not empty. That finds every pair: take the
node whose choice ends at the lower bucket; one of its d + 1 buckets is unchanged in the other, thus not empty and chosen there
too. (Buckets in use can fall short of d + 1 only if 64 or more hashed members meet in a quarter as many buckets.) Sets are
dealt by size bands, each band with a number of buckets that suits it; a set just above a band also takes part in that band.
Sets of under ``SMALL`` members take their d + 1 smallest shingle hashes as buckets of one.

Wide sketches. Each node also has a bit sketch, the parity of its shingles by place; the Hamming distance of two sketches is at
most the difference of their sets. Pairs whose distance is over d are dropped before any text is compared.

Groups. All members of a bucket are compared with the group's smallest node first. Linked nodes become components. Where a bucket
still holds members of several components, each is compared with the one that is closest to it by wide sketch, for some
rounds; then all pairs that are left, block by block. So a large group of near copies costs some comparisons each, not one for
each pair, and no link between different components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import BYTE_BASE, WORD_BASE, PrefixHash, Scratch, Words, distilled, mapped, mix, ranges, signed, text_chunks
from earshot.llm.components import components

SHINGLE = 5
PERCENT = 80
SMALL = 64
SKETCH_BITS = 8
SKETCH_BYTES = 1 << 22
BLOCK = 512
HELD_PAIRS = 1 << 16
CLOSEST_ROUNDS = 8
MANY_LINKS = 20_000

NODES = "doc_id long, digest long, node long, members long, band int, sketch binary, buckets array<long>"
PAIR_TEXTS = "a long, b long"


def most_difference(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Largest difference of linked sets of x and y members: (x + y) (1 - s) / (1 + s)."""
    return ((x + y) * (100 - PERCENT)) // (100 + PERCENT)


class Sets:
    """The shingle sets of a run of documents: hashes, sorted and distinct within each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
        words = Words(data, offsets, lower=True)
        count = np.diff(words.bounds)
        grams = words.grams(size) if len(words.hash) >= size else np.zeros(0, np.uint64)
        doc = np.repeat(np.arange(len(count)), count)
        start = np.arange(len(words.hash))
        whole = start + size <= words.bounds[1:][doc]
        doc, hashes = doc[whole], grams[start[whole]]
        short = np.flatnonzero((count > 0) & (count < size))
        if len(short):  # fewer words than a shingle: all of them as one
            ends = PrefixHash(words.hash, WORD_BASE).slices(words.bounds[short], words.bounds[short + 1])
            doc, hashes = np.concatenate([doc, short]), np.concatenate([hashes, mix(ends + count[short].astype(np.uint64))])
        order = np.lexsort((hashes, doc))
        doc, hashes = doc[order], hashes[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
        self.hashes = hashes[new]
        self.bounds = np.searchsorted(doc[new], np.arange(len(count) + 1))

    def __getitem__(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]


def _bands(n: np.ndarray) -> np.ndarray:
    """The size band of sets of n members: the largest power of two that is not above n."""
    return np.frexp(n.astype(np.float64))[1].astype(np.int64) - 1


def _node_hashes(sets: Sets, full: np.ndarray) -> np.ndarray:
    """A hash of each set, from the sum of its members' mixed hashes."""
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(mix(sets.hashes), sets.bounds[full])
        return signed(mix(sums + np.diff(sets.bounds)[full].astype(np.uint64)))


def _sketches(sets: Sets, full: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the wide sketches of the sets."""
    bits = np.maximum(64, np.left_shift(SKETCH_BITS, bands))
    edges = np.concatenate([[0], np.cumsum(bits)])
    own = np.repeat(np.arange(len(full)), np.diff(sets.bounds)[full])
    place = (mix(sets.hashes ^ np.uint64(BYTE_BASE)) >> np.uint64(20)).astype(np.int64) & (bits[own] - 1)
    odd = np.bincount(edges[own] + place, minlength=int(edges[-1])) & 1
    return np.packbits(odd.astype(np.uint8)), edges >> 3


def _places_in(group: np.ndarray) -> np.ndarray:
    """Each element's place among those of its group; groups lie together."""
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    at = np.flatnonzero(new)
    return np.arange(len(group)) - np.repeat(at, np.diff(np.append(at, len(group))))


def _chosen(sets: Sets, doc: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket key, index of its set in ``doc``) of the buckets that sets choose in the given bands."""
    n = np.diff(sets.bounds)[doc]
    need = most_difference(n, n * 100 // PERCENT) + 1
    with np.errstate(over="ignore"):
        salt = (bands + 1).astype(np.uint64) * np.uint64(BYTE_BASE)
        keys, owners = [], []
        for small in (True, False):
            use = np.flatnonzero((np.left_shift(1, bands) < SMALL) == small)
            if not len(use):
                continue
            own = np.repeat(use, n[use])
            hashes = sets.hashes[ranges(sets.bounds[doc[use]], n[use])]
            mixed = mix(hashes + salt[own])
            if small:  # the smallest hashes are buckets of one
                order = np.lexsort((mixed, own))
                value, own = mixed[order], own[order]
                take = _places_in(own) < need[own]
                keys.append(mix(value[take] ^ salt[own[take]]))
                owners.append(own[take])
                continue
            dealt = (np.left_shift(9, bands) // 10).astype(np.uint64)
            place = ((mixed >> np.uint64(32)) * dealt[own] >> np.uint64(32)).astype(np.int64)
            slot = np.concatenate([[0], np.cumsum(dealt.astype(np.int64))])[own] + place
            order = np.argsort(slot, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(slot[order]) != 0]))
            value = np.bitwise_xor.reduceat(hashes[order], first)
            heavy = np.diff(np.append(first, len(order))) > 1
            own, place = own[order[first]], place[order[first]]
            among = np.cumsum(heavy) - heavy  # heavy buckets before this one
            start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            among -= np.repeat(among[start], np.diff(np.append(start, len(own))))
            enough = np.bincount(own, weights=heavy, minlength=len(doc)) >= need
            take = np.where(enough[own], heavy & (among < need[own]), True)
            keys.append(mix(value[take] ^ mix(salt[own[take]] + place[take].astype(np.uint64))))
            owners.append(own[take])
    return np.concatenate(keys), np.concatenate(owners)


def _bucket_lists(sets: Sets, full: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, offsets) of the buckets by which each set joins others, in its band and, near its lower edge, in the one below."""
    n = np.diff(sets.bounds)[full]
    below = np.flatnonzero((bands > 0) & (n * PERCENT < np.left_shift(100, bands)))  # a partner can be in the band below
    of = np.concatenate([np.arange(len(full)), below])
    keys, owner = _chosen(sets, full[of], np.concatenate([bands, bands[below] - 1]))
    owner = of[owner]
    order = np.argsort(owner, kind="stable")
    return keys[order], np.searchsorted(owner[order], np.arange(len(full) + 1))


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("digest"), F.col("text").cast("string"))


def nodes(docs: DataFrame) -> DataFrame:
    """The node, size, wide sketch and buckets of every row that has words, from one reading of the texts."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, _, data, offsets in text_chunks(batch.column(2)):
            sets = Sets(data, offsets)
            n = np.diff(sets.bounds)
            full = np.flatnonzero(n)
            if not len(full):
                continue
            rows = pa.array(full + first)
            bands = _bands(n[full])
            sketch, edges = _sketches(sets, full, bands)
            keys, ends = _bucket_lists(sets, full, bands)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(_node_hashes(sets, full)),
                    pa.array(n[full]),
                    pa.array(bands.astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(full), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(sketch)]),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(signed(keys))),
                ],
                names=[c.split()[0] for c in NODES.split(", ")],
            )

    return mapped(_identified(docs), run, NODES)


def _folded(sketches: np.ndarray, size: int) -> np.ndarray:
    """Wide sketches (a row each) of fewer bytes: places are taken modulo the size, so parts are added up by parity."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, size), axis=1)


def _near(one: pa.Array, two: pa.Array, allowed: np.ndarray) -> np.ndarray:
    """Whether the wide sketches of rows differ in at most so many places; rows of equal widths are compared together."""

    def parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        return np.frombuffer(column.buffers()[2], np.uint8), edges[:-1], np.diff(edges)

    (data_x, at_x, wide_x), (data_y, at_y, wide_y) = parts(one), parts(two)
    out = np.zeros(len(allowed), bool)
    for x, y in np.unique(np.stack([wide_x, wide_y], axis=1), axis=0).tolist():
        rows = np.flatnonzero((wide_x == x) & (wide_y == y))
        least = min(x, y)
        step = max(1, SKETCH_BYTES // max(x, y))
        for part in (rows[k : k + step] for k in range(0, len(rows), step)):
            p = _folded(data_x[at_x[part][:, None] + np.arange(x)], least)
            q = _folded(data_y[at_y[part][:, None] + np.arange(y)], least)
            out[part] = np.bitwise_count((p ^ q).view(np.uint64)).sum(axis=1, dtype=np.int64) <= allowed[part]
    return out


def _close(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and wide sketches allow a link."""
    one = known.select(F.col("node").alias("a"), F.col("members").alias("xa"), F.col("sketch").alias("sa"))
    two = known.select(F.col("node").alias("b"), F.col("members").alias("xb"), F.col("sketch").alias("sb"))
    rows = pairs.join(one, "a").join(two, "b").where(100 * F.least("xa", "xb") >= PERCENT * F.greatest("xa", "xb"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        allowed = most_difference(batch.column("xa").to_numpy(), batch.column("xb").to_numpy())
        keep = pa.array(_near(batch.column("sa"), batch.column("sb"), allowed))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return mapped(rows.select("a", "b", "xa", "sa", "xb", "sb"), run, PAIR_TEXTS)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that are linked, by their whole sets; ``texts``: (node, text)."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def sets(column: pa.Array) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for first, last, data, offsets in text_chunks(column):
            own = Sets(data, offsets)
            out += [own[i] for i in range(last - first)]
        return out

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            keep = []
            for x, y in zip(sets(part.column(2)), sets(part.column(3)), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return mapped(pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb"), run, PAIR_TEXTS)


def _across(groups: DataFrame, closest: bool) -> DataFrame:
    """Pairs of members of one bucket but of different components whose sketches allow a link, all or each one's closest.

    ``groups``: (bucket, node, component, members, sketch, size of the group). Large groups are cut into blocks; every two blocks meet
    in a task of their own.
    """
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).cast("int")
    dealt = groups.withColumn("parts", parts).withColumn("block", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", "component", "members", "sketch")
    width = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two nodes can meet in many buckets; a task tells of them once, as far as it remembers."""
        pairs = np.zeros((0, 2), np.int64)
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows < 8192:
                continue
            edge = int(groups_of(held)[-2])  # the last group may go on
            if edge:
                pairs = np.unique(np.concatenate([pairs, compare(held.slice(0, edge))]), axis=0)
                held = held.slice(edge)
            if len(pairs) >= HELD_PAIRS:
                yield told(pairs)
                pairs = pairs[:0]
        if held is not None and held.num_rows:
            pairs = np.unique(np.concatenate([pairs, compare(held)]), axis=0)
        yield told(pairs)

    def told(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], names=["a", "b"])

    def groups_of(rows: pa.Table) -> np.ndarray:
        """Where groups begin, and the end."""
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for c in keys:
            v = rows.column(c).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.append(np.flatnonzero(new), rows.num_rows)

    def compare(rows: pa.Table) -> np.ndarray:
        nodes_, comps, sizes, blocks, one, two = (rows.column(c).to_numpy().astype(np.int64) for c in ("node", "component", "members", "block", "one", "two"))
        sketches = rows.column("sketch").to_pylist()
        edges = groups_of(rows)
        found = [np.zeros((0, 2), np.int64)]
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a < 2 or (comps[a:b] == comps[a]).all():
                continue
            own = [np.frombuffer(x, np.uint8) for x in sketches[a:b]]
            least = min(map(len, own))
            sketch = np.concatenate([_folded(x[None], least) for x in own]).view(np.uint64)
            node, comp, n, block = nodes_[a:b], comps[a:b], sizes[a:b], blocks[a:b]
            for i in range(b - a - 1):
                far = np.arange(i + 1, b - a)
                ok = (comp[far] != comp[i]) & (100 * np.minimum(n[far], n[i]) >= PERCENT * np.maximum(n[far], n[i]))
                if one[a] != two[a]:
                    ok &= block[far] != block[i]
                far = far[ok]
                if not len(far):
                    continue
                distance = np.bitwise_count(sketch[far] ^ sketch[i]).sum(axis=1, dtype=np.int64)
                near = distance <= most_difference(n[far], n[i])
                far, distance = far[near], distance[near]
                if closest and len(far):
                    far = far[[int(distance.argmin())]]
                found.append(np.stack([np.minimum(node[far], node[i]), np.maximum(node[far], node[i])], axis=1))
        return np.concatenate(found)

    keys = ["bucket", "one", "two"]
    return dealt.repartition(width, *keys).sortWithinPartitions(*keys).mapInArrow(run, PAIR_TEXTS).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), n_shingles, component (a node) and component_id of every row that has words."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows, _ = scratch.store(nodes(docs), "nodes")
    known = rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "digest")).alias("of"), F.min("members").alias("members"), F.min("sketch").alias("sketch"))
    known, _ = scratch.store(known, "known")
    scratch.tidy()
    # a row that is there twice would pair its text twice
    repeats = rows.count() > rows.select("doc_id", "digest").distinct().count()

    buckets = rows.select(F.explode("buckets").alias("bucket"), "node")
    pivots = buckets.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot < last").drop("last")
    pivots, _ = scratch.store(pivots, "pivots")
    scratch.tidy()
    groups, _ = scratch.store(buckets.join(pivots, "bucket").where("node > pivot").distinct(), "groups")
    scratch.tidy()

    def link(pairs: DataFrame, label: str) -> DataFrame:
        """Linked ones among pairs, with the texts of their nodes read by document."""
        close, _ = scratch.store(_close(pairs, known), label)
        used = close.select(F.col("a").alias("node")).unionByName(close.select(F.col("b").alias("node"))).distinct()
        of = known.join(used, "node").select("node", F.col("of.doc_id").alias("_doc"), F.col("of.digest").alias("_digest"))
        found = _identified(docs).join(of, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest")))
        texts = found.groupBy("node").agg(F.first("text").alias("text")) if repeats else found.select("node", "text")
        return scratch.store(verified(close, texts), f"{label}-linked")[0]

    # first the smallest of the smallest nodes that a node meets, then the others where components still differ
    nearest = groups.groupBy("node").agg(F.min("pivot").alias("pivot"))
    links = link(nearest.select(F.col("pivot").alias("a"), F.col("node").alias("b")), "star")
    parts, _ = scratch.store(components(links), "parts")
    scratch.tidy()
    others = groups.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct().join(nearest.select(F.col("pivot").alias("a"), F.col("node").alias("b")), ["a", "b"], "left_anti")
    for side in ("a", "b"):
        label = parts.select(F.col("node").alias(side), F.col("component").alias(f"part_{side}"))
        others = others.join(label, side, "left").withColumn(f"part_{side}", F.coalesce(f"part_{side}", side))
    links = links.unionByName(link(others.where("part_a != part_b").select("a", "b"), "stars"))
    parts, _ = scratch.store(components(links), "parts")
    scratch.tidy()

    # Buckets whose members, apart from the smallest, are still of several components. Each member's closest one of another
    # component comes first, again and again while that joins components; then all pairs that are left.
    rounds = 0
    while True:
        member = groups.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
        member, path = scratch.store(member, "member")
        open_ = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket", "size")
        wide = member.join(open_, "bucket").join(known.select("node", "members", "sketch"), "node")
        closest = rounds < CLOSEST_ROUNDS
        found = link(_across(wide.select("bucket", "node", "component", "members", "sketch", "size"), closest), "rest")
        scratch.tidy()
        scratch.drop(path)
        links = links.unionByName(found)
        if not closest:
            break
        # another such round pays where this one has joined much; the last round leaves nothing out
        rounds = rounds + 1 if found.count() >= MANY_LINKS else CLOSEST_ROUNDS
        parts, _ = scratch.store(components(links), "parts")

    whole = components(links)
    named = known.select("node", "least").join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    label = named.join(smallest, "component").select("node", "component", "component_id")
    return rows.join(label, "node").select("doc_id", "digest", F.col("members").alias("n_shingles"), "component", "component_id")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), n_shingles and component_id of every row.

    Rows without words, or with a null text, have no shingles and are components of their own. ``component_id`` is the smallest
    doc_id of a component; rows with a null id take part but are never that, unless all ids of a component are null.
    Repeated rows are in one component, as equal sets are one node. Columns besides doc_id and text are not read.
    """
    placed = distilled(docs.sparkSession, "placed", lambda: classes(docs)).groupBy("doc_id", "digest").agg(F.min("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"))
    placed = placed.select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"), "n_shingles", "component_id")
    ids = _identified(docs).select("doc_id", "digest")
    rows = ids.join(placed, F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("digest").eqNullSafe(F.col("_digest")), "left")
    return rows.select("doc_id", "digest", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those that are linked, in one or more steps, to one of smaller doc_id (null first, then by text).

    Of rows equal in doc_id and text one stays. Rows without words link with nothing and all stay. All columns stay.
    """
    placed = distilled(docs.sparkSession, "placed", lambda: classes(docs).select("doc_id", "digest", "component"))
    first = placed.groupBy("component").agg(F.min(F.struct("doc_id", "digest")).alias("kept"))
    kept = first.select(F.col("kept.doc_id").alias("_doc"), F.col("kept.digest").alias("_digest"))
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("key"), text.rlike("[^\\x20\\x09-\\x0D]").alias("worded"))
    same = F.col("id").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_digest"))
    one = rows.where("worded").join(kept, same, "left_semi").dropDuplicates(["id", "key"])
    return one.unionByName(rows.where("NOT coalesce(worded, false)")).select("row.*")


ORACLE = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), t AS (
  SELECT doc_id, len(ws) AS total, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w
), win AS (
  SELECT doc_id, pos, total, string_agg(word, ' ') OVER ahead AS body, count(*) OVER ahead AS n FROM t
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {SHINGLE - 1} FOLLOWING)
), shingle AS (
  SELECT DISTINCT doc_id, body FROM win WHERE n = {SHINGLE} OR (total < {SHINGLE} AND pos = 1)
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.body = b.body AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM both_ JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * both_.n >= {PERCENT} * (x.n + y.n - both_.n)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
)
SELECT d.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, (SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id) AS component_id
FROM documents d LEFT JOIN size ON size.doc_id = d.doc_id
"""
