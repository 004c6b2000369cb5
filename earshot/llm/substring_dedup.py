"""Removal of long repeated word sequences by compaction of a De Bruijn graph of words.

Each window of ``WINDOW`` words is an edge. Neighbouring edges with one anchor are compacted into paths (``paths.py``), and equal
paths of all documents meet in one aggregate, which finds the first document that has the path, its source. Where paths with a
common anchor branch, they are cut into single edges, and the source of each edge is found in the same way. A word goes if it
lies in an edge whose source has a smaller doc_id. Sources are documents and places, so every repeated span can be held against
its source (``spans``).

No group is brought into one task: sources come from combining aggregates and reach the paths by joins that Spark splits where
they are skewed. Only differing paths under a common anchor have their text read a second time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import Scratch, Words, distilled, mapped, ranges, signed, text_chunks
from earshot.llm.paths import NO_ID, Paths, covered_units, identified, with_texts

WINDOW = 13
ANCHOR = 4
RESULT = "doc_id long, n_words long, n_removed long, kept_text string"
EDGES = "anchor long, edge long, doc long, at long"


def edges(docs: DataFrame, paths: DataFrame, graph: Paths) -> DataFrame:
    """The single windows of some paths (doc, at, anchor, shape), with their hashes."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        spans = batch.column(3)
        for first, last, data, offsets in text_chunks(batch.column(2)):
            units, bounds = graph.units(data, offsets)
            own = spans.slice(first, last - first)
            flat = own.flatten()
            doc = np.repeat(np.arange(last - first), [len(x) for x in own])
            count = flat.field("shape").to_numpy(zero_copy_only=False).astype(np.int64) & 0xFFFF
            begin = flat.field("first").to_numpy(zero_copy_only=False).astype(np.int64)
            start = ranges(begin, count)
            owner = np.repeat(doc, count)
            at = start + bounds[owner]
            rows = pa.array(owner + first)
            digest = batch.column(1).take(rows).to_numpy()
            anchors = np.repeat(flat.field("anchor").to_numpy(zero_copy_only=False), count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), pa.array(signed(units.slices(at, at + graph.window))), batch.column(0).take(rows), pa.array((digest << 32) | start)],
                names=["anchor", "edge", "doc", "at"],
            )

    return mapped(with_texts(docs, paths), run, EDGES)


def repeated(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Runs of windows that a document of smaller id has too: (doc, at, count), ``at`` being document hash and first word."""
    graph = Paths(window, anchor, words=True)
    scratch = Scratch(docs.sparkSession)
    paths, _ = scratch.store(graph.candidates(docs, by_order=True), "paths")
    scratch.tidy()
    count = F.col("shape").bitwiseAND(F.lit(0xFFFF)).cast("long").alias("count")
    sources = paths.groupBy("anchor", "path").agg(F.min("doc").alias("source"))
    sources, _ = scratch.store(sources, "sources")
    placed = paths.join(sources.withColumnRenamed("anchor", "of"), (F.col("anchor") == F.col("of")) & (paths["path"] == sources["path"])).drop("of", sources["path"])
    later = placed.where("doc > source").select("doc", "at", count)
    # under anchors with several paths, the first holders' paths are compared edge by edge
    branching = sources.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("source").alias("least"), F.max("source").alias("most")).where("n > 1 and least < most")
    holders = placed.where("doc = source").join(branching.select("anchor"), "anchor").select("doc", "at", "anchor", "shape")
    single, _ = scratch.store(edges(docs, holders, graph), "edges")
    scratch.tidy()
    firsts = single.groupBy("anchor", "edge").agg(F.min("doc").alias("source"), F.max("doc").alias("most")).where("source < most").drop("most")
    firsts, _ = scratch.store(firsts, "firsts")
    cut = single.join(firsts, ["anchor", "edge"]).where("doc > source").select("doc", "at", F.lit(1).cast("long").alias("count"))
    return later.unionByName(cut)


def dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per row doc_id, n_words, n_removed and the kept words, joined by one blank.

    A null text has no words and its kept text is empty. Rows with one doc_id do not cover one another, whatever their texts; a
    null doc_id counts as smaller than all others. Words are those of ``Words``; a document shorter than a window keeps all.
    """
    runs = distilled(docs.sparkSession, "runs", lambda: repeated(docs, window, anchor))
    grouped = runs.select("doc", F.shiftright("at", 32).alias("digest"), F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).alias("first"), "count")
    grouped = grouped.groupBy("doc", "digest").agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    rows = identified(docs).join(grouped, ["doc", "digest"], "left").select("doc", "text", "runs")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for begin, end, data, offsets in text_chunks(batch.column(1)):
            words = Words(data, offsets)
            runs = batch.column(2).slice(begin, end - begin)
            raw = data.tobytes()
            sizes, removed, kept = [], [], []
            for i in range(end - begin):
                a, b = int(words.bounds[i]), int(words.bounds[i + 1])
                keep = np.ones(b - a, bool)
                found = runs[i].values
                if found is not None and len(found):
                    keep = ~covered_units(b - a, found.field("first").to_numpy(zero_copy_only=False), found.field("count").to_numpy(zero_copy_only=False), window)
                spans = zip(words.start[a:b][keep].tolist(), words.end[a:b][keep].tolist(), strict=True)
                kept.append(b" ".join([raw[s:e] for s, e in spans]).decode())
                sizes.append(b - a)
                removed.append(b - a - int(keep.sum()))
            ids = batch.column(0).slice(begin, end - begin).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=ids == NO_ID), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return mapped(rows, run, RESULT)


ORACLE = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), t AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w
), win AS (
  SELECT doc_id, pos, string_agg(word, ' ') OVER ahead AS body, count(*) OVER ahead AS n FROM t
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)
), firsts AS (
  SELECT body, min(doc_id) AS source FROM win WHERE n = {WINDOW} GROUP BY body
), gone AS (
  SELECT DISTINCT doc_id, pos + step AS pos
  FROM win JOIN firsts USING (body) CROSS JOIN (SELECT unnest(range({WINDOW})) AS step) WHERE n = {WINDOW} AND source < doc_id
), kept AS (
  SELECT t.doc_id, count(*) AS n, string_agg(t.word, ' ' ORDER BY t.pos) AS text
  FROM t ANTI JOIN gone ON t.doc_id = gone.doc_id AND t.pos = gone.pos GROUP BY t.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
