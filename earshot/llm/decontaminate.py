"""Benchmark decontamination: training passages as BM25 queries to an inverted index of test items, with block maxima.

Test items, cut into units of at most ``UNIT`` words, are what the index holds; a term's impact in a unit is its BM25 weight as
a share of the unit's whole weight, so a passage that holds a whole unit scores 1. Units lie in blocks of ``BLOCK``; for every
term the index knows its largest impact in each block and at all.

Every document is cut into cells of ``UNIT`` words, and every two cells that follow one another are a passage, so any unit that a
document holds lies whole in a passage. As in block-max WAND, a passage whose terms' largest impacts cannot add up to the
threshold is passed over, then so is every block whose own maxima cannot; units of the blocks that are left are scored exactly, and
all at or above the threshold are retrieved. A retrieved unit is verified: of the word pairs of its first part, the question, and
of its last part, the answer, a share must stand in the passage. An item of under ``LEAST_WORDS`` words has too few pairs for that: all its
terms must be in the passage, and its words must stand there one after another. For that its impacts add up to the threshold only.

The index goes to all tasks in shards of a bounded number of postings, one pass over the documents for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import WORD_BASE, Words, empty_as, mapped, mix, ranges, signed, text_chunks

UNIT = 64
BLOCK = 4
LEAST_SCORE = 0.6
LEAST_QUESTION = 0.6
LEAST_ANSWER = 0.5
LEAST_WORDS = 8
ANSWER_WORDS = 4
K1 = 1.2
B = 0.75
MOST_POSTINGS = 2_000_000
MOST_SLOTS = 1 << 20

UNITS = "item_id long, unit int, words array<long>, answer int"
FOUND = "doc_id long, item_id long, score double, question double, answer double"


@dataclass
class Index:
    """One shard. Postings of term i: first[i] to first[i + 1] in ``unit`` and ``impact``; the same for blocks."""

    terms: np.ndarray
    first: np.ndarray
    unit: np.ndarray
    impact: np.ndarray
    block_first: np.ndarray
    block: np.ndarray
    block_impact: np.ndarray
    items: np.ndarray
    question: list[np.ndarray]
    answer: list[np.ndarray]
    exact: list[np.ndarray | None]

    @property
    def blocks(self) -> int:
        return -(-len(self.items) // BLOCK)


def units(items: DataFrame) -> DataFrame:
    """Units of the test items: their words' hashes, and how many of the last ones are the answer.

    The answer is an item's last sentence, at least ``ANSWER_WORDS`` words; of an item of several units it is the last unit's, and
    the other units' answers are their last ``ANSWER_WORDS`` words. An item of under ``LEAST_WORDS`` words has no answer apart (0).
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for first, last, data, offsets in text_chunks(batch.column(1)):
            words = Words(data, offsets, bare=True)
            for i in range(last - first):
                a, b = int(words.bounds[i]), int(words.bounds[i + 1])
                if a == b:
                    continue
                own = data[offsets[i] : offsets[i + 1]]
                stops = np.flatnonzero(np.isin(own[:-1], list(b".?!")) & np.isin(own[1:], list(b" \n\t\r"))) + offsets[i]
                tail = b - int(np.searchsorted(words.start, stops[-1])) if len(stops) else 0
                cuts = -(-(b - a) // UNIT)
                edges = [a + (b - a) * k // cuts for k in range(cuts + 1)]
                for k, (x, y) in enumerate(zip(edges, edges[1:], strict=False)):
                    answer = tail if k == cuts - 1 else 0
                    answer = min(max(answer, ANSWER_WORDS), (y - x) // 2) if b - a >= LEAST_WORDS else 0
                    rows.append((batch.column(0)[first + i].as_py(), k, signed(words.hash[x:y]).tolist(), answer))
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["item_id", "unit", "words", "answer"])

    return mapped(items.select(F.col("item_id").cast("long"), F.col("text").cast("string")), run, UNITS).dropDuplicates(["item_id", "unit", "words"])


def _pairs(words: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words, distinct."""
    with np.errstate(over="ignore"):
        return np.unique(mix(words[:-1] * np.uint64(WORD_BASE) + mix(words[1:])))


def _runs_in(short: np.ndarray, passage: np.ndarray) -> bool:
    """Whether the words stand in the passage one after another."""
    n = len(passage) - len(short) + 1
    return n > 0 and bool(np.logical_and.reduce([passage[i : i + n] == w for i, w in enumerate(short)]).any())


def _postings(key: np.ndarray, group: np.ndarray, value: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((group, key))
    key, group, value = key[order], group[order], value[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
    at = np.flatnonzero(new)
    return np.searchsorted(key[at], np.arange(terms + 1)), group[at], np.maximum.reduceat(value, at) if len(at) else value


def build(rows: list, frequency: dict[int, int], total: int, mean: float) -> Index:
    """The index of a shard's units; document frequencies, number and mean length are those of all units."""
    rows = sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["unit"], r["words"]))
    words = [np.array(r["words"], np.int64) for r in rows]
    sizes = np.array([len(w) for w in words])
    unit = np.repeat(np.arange(len(rows)), sizes)
    flat = np.concatenate(words) if words else np.zeros(0, np.int64)
    terms, number = np.unique(flat, return_inverse=True)
    pair, counts = np.unique(unit * np.int64(len(terms) + 1) + number, return_counts=True)
    unit, number = pair // (len(terms) + 1), pair % (len(terms) + 1)
    df = np.array([frequency[int(t)] for t in terms], np.float64)
    idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
    weight = idf[number] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * sizes[unit] / mean))
    short = np.array([r["answer"] == 0 for r in rows])
    impact = weight / np.bincount(unit, weights=weight, minlength=len(rows))[unit] * np.where(short[unit], LEAST_SCORE, 1)
    first, postings, impacts = _postings(number, unit, impact, len(terms))
    block_first, block, block_impact = _postings(number, unit // BLOCK, impact, len(terms))
    plain = [w.view(np.uint64) for w in words]
    return Index(
        terms,
        first,
        postings,
        impacts,
        block_first,
        block,
        block_impact,
        np.array([-(1 << 63) if r["item_id"] is None else r["item_id"] for r in rows], np.int64),
        [_pairs(w[: len(w) - r["answer"] + 1]) for w, r in zip(plain, rows, strict=True)],
        [_pairs(w[len(w) - r["answer"] - 1 :]) if r["answer"] else w[:0] for w, r in zip(plain, rows, strict=True)],
        [None if r["answer"] else w for w, r in zip(plain, rows, strict=True)],
    )


def indexes(items: DataFrame, most: int = MOST_POSTINGS) -> Iterator[Index]:
    """The index in shards of about ``most`` postings."""
    parts = units(items).cache()
    try:
        total, words = parts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
        if not total:
            return
        shards = max(1, -(-words // most))
        term = parts.select("item_id", "unit", F.explode(F.array_distinct("words")).alias("term"))
        frequency = term.groupBy("term").count()
        shard = F.pmod(F.xxhash64("item_id", "unit"), F.lit(shards))
        for k in range(shards):
            own = parts.where(shard == k)
            used = own.select(F.explode("words").alias("term")).distinct()
            yield build(own.collect(), {r["term"]: r["count"] for r in frequency.join(used, "term").collect()}, total, words / total)
    finally:
        parts.unpersist()


def hits(index: Index, data: np.ndarray, offsets: np.ndarray, least: float = LEAST_SCORE) -> list[tuple[int, int, float, float, float]]:
    """(document, unit, score, question share, answer share) of all verified units of a run of documents, the best of each."""
    words = Words(data, offsets, bare=True)
    count = np.diff(words.bounds)
    cells = -(-count // UNIT)
    doc_of_cell = np.repeat(np.arange(len(count)), cells)
    cell_first = np.cumsum(cells) - cells
    doc = np.repeat(np.arange(len(count)), count)
    cell = cell_first[doc] + (np.arange(len(doc)) - words.bounds[:-1][doc]) // UNIT
    n = len(doc_of_cell)
    if not n or not len(index.terms):
        return []
    key = signed(words.hash)
    at = np.minimum(np.searchsorted(index.terms, key), len(index.terms) - 1)
    known = index.terms[at] == key
    pair = np.unique(cell[known] * np.int64(len(index.terms)) + at[known])  # a term counts once in a cell
    cell, term = pair // len(index.terms), pair % len(index.terms)
    top = np.maximum.reduceat(index.block_impact, index.block_first[:-1])
    bound = np.bincount(cell, weights=top[term], minlength=n)
    follows = np.zeros(n, bool)  # whether the next cell is of the same document
    follows[:-1] = doc_of_cell[1:] == doc_of_cell[:-1]
    with_next = bound + np.where(follows, np.append(bound[1:], 0), 0)
    alive = with_next >= least - 1e-9
    need = alive.copy()
    need[1:] |= alive[:-1] & follows[:-1]
    use = need[cell]
    cell, term = cell[use], term[use]
    size = index.block_first[term + 1] - index.block_first[term]
    where = ranges(index.block_first[term], size)
    block, impact, of = index.block[where], index.block_impact[where], np.repeat(cell, size)
    live: list[tuple[int, int]] = []
    step = max(1, MOST_SLOTS // index.blocks)
    for at in range(0, n, step):  # sums of a run of cells, and one more, by block
        end = min(at + step, n)
        a, b = np.searchsorted(of, [at, end + 1])
        sums = np.bincount((of[a:b] - at) * index.blocks + block[a:b], weights=impact[a:b], minlength=(end + 1 - at) * index.blocks).reshape(-1, index.blocks)
        joined = sums[: end - at] + np.where(follows[at:end, None], sums[1 : end - at + 1], 0)
        row, column = np.nonzero(joined >= least - 1e-9)
        live += zip((row + at).tolist(), column.tolist(), strict=True)
    starts = np.searchsorted(cell, np.arange(n + 1))
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for c, b in live:
        own = term[starts[c] : starts[c + 1]]
        if follows[c]:
            own = np.union1d(own, term[starts[c + 1] : starts[c + 2]])
        size = index.first[own + 1] - index.first[own]
        where = ranges(index.first[own], size)
        inside = index.unit[where] // BLOCK == b
        scores = np.bincount(index.unit[where][inside] - b * BLOCK, weights=index.impact[where][inside], minlength=BLOCK)
        for k in np.flatnonzero(scores >= least - 1e-9):
            u, d = b * BLOCK + int(k), int(doc_of_cell[c])
            a = int(words.bounds[d]) + (c - int(cell_first[d])) * UNIT
            passage = words.hash[a : min(a + (2 if follows[c] else 1) * UNIT, int(words.bounds[d + 1]))]
            short = index.exact[u]
            if short is not None:
                if _runs_in(short, passage):
                    best[d, u] = (1.0, 1.0, 1.0)
                continue
            seen = _pairs(passage)
            question = float(np.isin(index.question[u], seen).mean())
            answer = float(np.isin(index.answer[u], seen).mean())
            if question >= LEAST_QUESTION and answer >= LEAST_ANSWER:
                best[d, u] = max(best.get((d, u), (0.0, 0.0, 0.0)), (float(scores[k]), question, answer))
    return [(d, u, *v) for (d, u), v in best.items()]


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question, answer) of every document that holds a test item.

    Of an item's units and of a document's passages the best counts. Null texts hold nothing. Repeated documents with one id give
    one row an item; null ids count as one id. Items with equal text are found each; items without words are in no document. An item of
    a word or two is in every document with these words. Empty tables give no rows.
    """
    spark = docs.sparkSession
    out = empty_as(FOUND, spark)
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    for index in indexes(items):
        sent = spark.sparkContext.broadcast(index)

        def run(batch: pa.RecordBatch, sent=sent) -> Iterator[pa.RecordBatch]:
            for first, _, data, offsets in text_chunks(batch.column(1)):
                rows = hits(sent.value, data, offsets)
                if rows:
                    doc, unit, score, question, answer = zip(*rows, strict=True)
                    item = sent.value.items[list(unit)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([d + first for d in doc])), pa.array(item, mask=item == -(1 << 63)), pa.array(score), pa.array(question), pa.array(answer)],
                        names=["doc_id", "item_id", "score", "question", "answer"],
                    )

        out = out.unionByName(mapped(plain, run, FOUND))
    best = out.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "question", "answer")).alias("best"))
    return best.select("doc_id", "item_id", "best.*")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without those that hold a test item; every row is judged by its own text, all columns stay."""
    spark = docs.sparkSession
    text = docs.columns.index("text")
    for index in indexes(items):
        sent = spark.sparkContext.broadcast(index)

        def run(batch: pa.RecordBatch, sent=sent) -> Iterator[pa.RecordBatch]:
            keep = np.ones(batch.num_rows, bool)
            for first, _, data, offsets in text_chunks(batch.column(text)):
                keep[np.array([first + h[0] for h in hits(sent.value, data, offsets)], np.int64)] = False
            yield batch.filter(pa.array(keep))

        docs = mapped(docs, run, docs.schema)
    return docs
