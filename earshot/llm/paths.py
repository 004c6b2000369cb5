"""Windows of K units (bytes or words) that occur more than once, found through paths of windows with a common anchor.

Windows are the edges of a De Bruijn graph, and windows that follow one another in a text are neighbouring edges. Every window
has an anchor, the smallest-hashed run of M units in it, the last one among equals; equal windows have equal anchors at equal
places. Windows that follow one another and share one anchor form a path, a piece of text a little longer than a window. So a
text has a path for about every (K - M) / 2 units, not a window for each, and equal stretches of text have equal paths inside.

``Paths.scan`` lists the paths of every document; ``candidates`` keeps those whose anchor occurs again. Of a path that is repeated as a
whole, all windows are repeated. Paths that share an anchor but differ are left to the caller, which compares their windows.
Keys are the hashes of anchor and path, 128 bits together.

A document is known by ``doc``, its id (null: the smallest number), and the upper half of ``at``, a hash of its text, which tells
rows of one id apart; the lower half of ``at`` is a path's first unit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import WORD_BASE, PrefixHash, Scratch, Words, byte_hash, mapped, signed, text_chunks

PATHS = "anchor long, path long, doc long, at long, shape int"
NO_ID = -(1 << 63)
_PLACE_BITS = 30


def identified(docs: DataFrame) -> DataFrame:
    """(doc, digest, text) of every row; ``digest`` has 32 bits."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(F.col("text").cast("string")).bitwiseAND(F.lit(0x7FFFFFFF)).alias("digest"),
        F.col("text").cast("string").alias("text"),
    )


def smallest_places(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` hashes the place of its smallest one, the last among equals (compared by their upper bits)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = (1 << _PLACE_BITS) - 1
    packed = (values & ~np.uint64(low)) | (np.uint64(low) - np.arange(len(values), dtype=np.uint64))
    span = 1
    while span * 2 <= width:
        packed = np.minimum(packed[:-span], packed[span:])
        span *= 2
    rest = width - span
    packed = np.minimum(packed[: n], packed[rest : rest + n]) if rest else packed[:n]
    return (np.uint64(low) - (packed & np.uint64(low))).astype(np.int64)


@dataclass(frozen=True)
class Paths:
    window: int  # K
    anchor: int  # M
    words: bool

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[PrefixHash, np.ndarray]:
        """Prefix hash over the units, and where each document's units begin and the last one's end."""
        if self.words:
            words = Words(data, offsets)
            return PrefixHash(words.hash, WORD_BASE), words.bounds
        return byte_hash(data), offsets

    def cut(self, units: PrefixHash, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, first window, number of windows, anchor place) of all paths of a run of documents."""
        size = len(units.sums) - 1
        starts = np.arange(max(0, size - self.window + 1))
        place = smallest_places(units.windows(self.anchor), self.window - self.anchor + 1)
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(starts)]
        inside = starts + self.window <= bounds[1:][doc] if len(doc) else np.zeros(0, bool)
        starts, place, doc = starts[inside], place[inside], doc[inside]
        if not len(starts):
            return (np.zeros(0, np.int64),) * 4
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(starts)))
        return doc[first], starts[first], count, place[first]

    def scan(self, docs: DataFrame) -> DataFrame:
        """All paths of all documents. ``shape``: number of windows, and in the upper 16 bits the anchor's distance from the first."""

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for first, _, data, offsets in text_chunks(batch.column(2)):
                units, bounds = self.units(data, offsets)
                doc, start, count, place = self.cut(units, bounds)
                if not len(doc):
                    continue
                anchor = units.slices(place, place + self.anchor)
                path = units.slices(start, start + count - 1 + self.window)
                rows = pa.array(doc + first)
                digest = batch.column(1).take(rows).to_numpy()
                at = (digest << 32) | (start - bounds[:-1][doc])
                shape = (count | (place - start) << 16).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(anchor)), pa.array(signed(path)), batch.column(0).take(rows), pa.array(at), pa.array(shape)],
                    names=["anchor", "path", "doc", "at", "shape"],
                )

        return mapped(identified(docs), run, PATHS)

    def candidates(self, docs: DataFrame, by_order: bool) -> DataFrame:
        """Paths whose anchor occurs again; with ``by_order``, in another document."""
        found = self.scan(docs).select("anchor", "doc").groupBy("anchor")
        if by_order:
            again = found.agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
        else:
            again = found.agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        # a stored side lets Spark split the join where one anchor is very frequent
        kept, _ = Scratch(docs.sparkSession).store(again.select("anchor"), "anchors")
        return self.scan(docs).join(kept, "anchor")


def with_texts(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, digest, text, spans) of the documents that have spans; ``spans``: rows (doc, at, ...)."""
    rest = [c for c in spans.columns if c not in ("doc", "at")]
    keyed = spans.select("doc", F.shiftright("at", 32).alias("digest"), F.struct(F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("first"), *rest).alias("span"))
    grouped = keyed.groupBy("doc", "digest").agg(F.collect_list("span").alias("spans"))
    return identified(docs).join(grouped, ["doc", "digest"])


def covered_units(size: int, first: np.ndarray, count: np.ndarray, window: int) -> np.ndarray:
    """Which of ``size`` units lie in windows that start at first, first + 1, ... (count of them)."""
    delta = np.zeros(size + 1, np.int64)
    np.add.at(delta, first, 1)
    np.add.at(delta, np.minimum(first + count - 1 + window, size), -1)
    return np.cumsum(delta[:-1]) > 0
