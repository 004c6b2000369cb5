"""Removal of repeated lines by winnowing over line hashes.

Lines end at line feeds; lines of white space only are left out of all comparison and always stay. A line goes if it occurs earlier
too: in a document that comes first (by doc_id, then text), or further up in the same document.

Winnowing slides a window of ``WINDOW`` lines over a document's line hashes and selects the smallest hash of every window, the last
one among equals; a document of fewer lines is one window. So every run of ``WINDOW`` lines or more that two documents share has
a selected place at the same line of both, and places are at most ``WINDOW`` lines apart. A place is joined to the first occurrence
of its fingerprint (two hashes of the line), and the match is extended both ways, line by line, as far as the places' surroundings agree:
``WINDOW`` - 1 lines, which is where the next place of a longer run takes over. These later runs are deleted. Then the lines that no
run covered, single repeated lines between others among them, are judged by their own hashes. The first occurrence of a line is in
no deleted run, so it is still among them, and the result is the same as if every line had been judged.

Texts are read once for the hashes, which are kept, a row per document. First occurrences are found by combining aggregates, so a line
that a third of the documents share costs one row a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import PrefixHash, Scratch, Words, mapped, mix, signed, text_chunks

WINDOW = 4
MIN_WORDS = 1  # what makes a line count
OTHER_BASE = 0xA0761D6478BD642F

_LINES = "doc_id long, digest long, hashes array<long>, others array<long>, places array<int>"
_KEY = ["fingerprint", "check"]
_DOC = ["doc_id", "digest"]


class Lines:
    """Lines that hold words: their place in the document, and two independent hashes of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets)
        cut = data == 10
        ends = np.union1d(np.flatnonzero(cut), offsets[1:][np.diff(offsets) > 0])  # where a line feed or a document ends a line
        at_feed = np.zeros(len(ends), bool)
        inside = ends < len(data)
        at_feed[inside] = cut[ends[inside]]
        start = np.concatenate([[0], (ends + at_feed)[:-1]]) if len(ends) else np.zeros(0, np.int64)
        # a line's first byte follows a line feed or starts its document, whichever is later
        doc = np.searchsorted(offsets, np.maximum(ends - 1, 0), "right") - 1
        start = np.maximum(start, offsets[doc]) if len(ends) else start
        number = np.concatenate([[0], np.cumsum(cut)])
        first, last = np.searchsorted(words.start, start), np.searchsorted(words.start, ends)
        keep = last > first
        self.doc, self.words = doc[keep], (last - first)[keep]
        start, end = start[keep], ends[keep]
        self.line = number[start] - number[offsets[self.doc]]
        self.hash = words.prefix.slices(start, end)
        values = mix(data.astype(np.uint64) + np.uint64(OTHER_BASE))
        self.other = PrefixHash(values, OTHER_BASE).slices(start, end)

    def selected(self, width: int) -> np.ndarray:
        """The places, as indexes, that the windows of all documents select."""
        n = len(self.hash)
        first = np.arange(n)
        end = np.searchsorted(self.doc, self.doc, "right")  # where the line's document ends
        start = np.searchsorted(self.doc, self.doc)
        first = first[(first + width <= end) | (first == start)]
        last = np.minimum(first + width, end[first]) - 1
        place, best = first.copy(), self.hash[first]
        for step in range(1, width):
            at = np.minimum(first + step, last)
            smaller = self.hash[at] <= best
            place, best = np.where(smaller, at, place), np.where(smaller, self.hash[at], best)
        return np.unique(place)


def line_hashes(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Per document that has lines: two hashes of each line that is not blank, and the places that winnowing selects.

    ``digest`` is a hash of the text that tells rows of one doc_id apart.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, last, data, offsets in text_chunks(batch.column(2)):
            lines = Lines(data, offsets)
            if not len(lines.doc):
                continue
            bounds = np.searchsorted(lines.doc, np.arange(last - first + 1))
            full = np.flatnonzero(np.diff(bounds))
            edges = pa.array(np.append(bounds[full], len(lines.doc)).astype(np.int32))
            chosen = lines.selected(width)
            cuts = pa.array(np.append(np.searchsorted(chosen, bounds[full]), len(chosen)).astype(np.int32))
            places = pa.array((chosen - bounds[lines.doc[chosen]]).astype(np.int32))
            rows = pa.array(full + first)
            columns = [batch.column(0).take(rows), batch.column(1).take(rows)]
            columns += [pa.ListArray.from_arrays(edges, pa.array(signed(x))) for x in (lines.hash, lines.other)]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(cuts, places)], names=[c.split()[0] for c in _LINES.split(", ")])

    return mapped(docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("digest"), F.col("text").cast("string")), run, _LINES)


def _occurrences(lines: DataFrame, at: Column, width: int = 1) -> DataFrame:
    """A row per place of ``at``: doc_id, digest, place, fingerprint, check, and the hashes of the ``width`` - 1 lines before and after."""

    def row(i: Column) -> Column:
        sides = [F.get("hashes", i + d) for d in (*range(-1, -width, -1), *range(1, width))]
        around = [F.array(*sides).alias("around")] if sides else []
        return F.struct(i.alias("place"), F.get("hashes", i).alias("fingerprint"), F.get("others", i).alias("check"), *around)

    return lines.select(*_DOC, F.inline(F.transform(at, row)))


def _where() -> Column:
    return F.struct(*_DOC, "place")


def _later(rows: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Occurrences that are not the first of their fingerprint, with that one as ``first``."""
    carried = [c for c in ("around",) if c in rows.columns]
    ends = rows.groupBy(*_KEY).agg(F.min(F.struct(*_DOC, "place", *carried)).alias("first"), F.max(_where()).alias("last"))
    first = F.struct(*[F.col("first")[c].alias(c) for c in (*_DOC, "place")])
    firsts, _ = scratch.store(ends.where(~first.eqNullSafe(F.col("last"))).drop("last"), label)  # stored, so that a skewed join can be split
    return rows.join(firsts, _KEY).where(_where() > first)


def _agreeing(offset: int, reach: int) -> Column:
    """How many of the ``reach`` lines on one side, from the place outwards, are equal in both surroundings."""
    differ = [~F.coalesce(F.get("around", F.lit(offset + k)) == F.get("first.around", F.lit(offset + k)), F.lit(False)) for k in range(reach)]
    return reduce(lambda rest, k: F.when(differ[k], k).otherwise(rest), reversed(range(reach)), F.lit(reach))


def later_runs(lines: DataFrame, scratch: Scratch, width: int = WINDOW) -> DataFrame:
    """Runs of lines that occur earlier too, as far as selected places tell: (doc_id, digest, low, high), counted without blank lines."""
    matched = _later(_occurrences(lines, F.col("places"), width), scratch, "places")
    return matched.select(*_DOC, (F.col("place") - _agreeing(0, width - 1)).alias("low"), (F.col("place") + _agreeing(width - 1, width - 1)).alias("high"))


def _repeated(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, digest, repeated): the lines of a document that go, counted without blank lines."""
    scratch = Scratch(docs.sparkSession)
    lines, _ = scratch.store(line_hashes(docs, width), "lines")
    runs = later_runs(lines, scratch, width).groupBy(*_DOC).agg(F.collect_set(F.struct("low", "high")).alias("runs"))
    covered = runs.select(*_DOC, F.array_distinct(F.flatten(F.transform("runs", lambda x: F.sequence(x["low"], x["high"])))).alias("repeated"))
    covered, _ = scratch.store(covered, "covered")
    of = covered.select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"), "repeated")
    open_ = lines.drop("places").join(of, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("hashes") - 1), F.coalesce("repeated", F.array().cast("array<int>")))
    single = _later(_occurrences(open_, left), scratch, "singles").groupBy(*_DOC).agg(F.collect_set("place").alias("repeated"))
    both = covered.unionByName(single).groupBy(*_DOC).agg(F.flatten(F.collect_list("repeated")).alias("repeated"))
    return both


def _cut(docs: DataFrame, width: int) -> DataFrame:
    """(row: the whole document, text: what is left of it, n_lines, n_removed).

    Every step's arrays are bound to a lambda's variable and the result leaves through ``inline``: Spark would copy a column that is read
    inside a lambda, or by a filter, into it, and then split the text again for every line.
    """
    gone = _repeated(docs, width).select(F.col("doc_id").alias("of"), F.col("digest").alias("like"), "repeated")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("digest"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("like")), "left")
    whole = F.col("row")["text"].cast("string")

    def every(lines: Column) -> Column:
        return F.sequence(F.lit(0), F.size(lines) - 1)

    def placed(d: Column) -> Column:
        solid = F.filter(every(d["lines"]), lambda i: F.get(d["lines"], i).rlike("[^\\x20\\x09-\\x0D]"))
        return F.struct(d["whole"].alias("whole"), d["lines"].alias("lines"), d["repeated"].alias("repeated"), F.when(d["repeated"].isNotNull(), solid).alias("solid"))

    def numbered(d: Column) -> Column:
        lost = F.coalesce(F.transform(d["repeated"], lambda i: F.get(d["solid"], i)), F.array().cast("array<int>"))
        return F.struct(d["whole"].alias("whole"), d["lines"].alias("lines"), lost.alias("gone"))

    def left(d: Column) -> Column:
        kept = F.array_join(F.transform(F.array_except(every(d["lines"]), d["gone"]), lambda i: F.get(d["lines"], i)), "\n")
        return F.struct(
            F.when(F.size(d["gone"]) > 0, kept).otherwise(d["whole"]).alias("text"),
            F.when(d["whole"].isNull(), 0).otherwise(F.size(d["lines"])).cast("long").alias("n_lines"),
            F.size(d["gone"]).cast("long").alias("n_removed"),
        )

    one = F.array(F.struct(whole.alias("whole"), F.split(whole, "\n", -1).alias("lines"), "repeated"))
    return joined.select("row", F.inline(reduce(F.transform, (placed, numbered, left), one)))


def dedup(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, text without the lines that repeat earlier ones, n_lines before, n_removed of them.

    Rows with equal doc_id and text are one document and each keep the same lines. Nulls in doc_id come before all ids. A null
    text stays null and has no lines; an empty text has one line. Further columns are not read.
    """
    return _cut(docs.select("doc_id", "text"), width).select("row.doc_id", "text", "n_lines", "n_removed")


def keep_first(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """The documents, all columns, with what ``dedup`` leaves of their texts; ``n_chars``, if there, follows the text.

    Documents that lost all their lines go.
    """
    out = _cut(docs, width).where((F.col("n_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    own = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[own[c].alias(c) if c in own else F.col("row")[c].alias(c) for c in docs.columns])


ORACLE = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
), w AS (
  SELECT doc_id, line, pos, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM l
), s AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS total FROM w WHERE n > 0
), e AS (
  SELECT a.doc_id, a.k, min(b.k) AS z FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.k BETWEEN a.k AND a.k + {MIN_WORDS - 1} AND b.total >= a.total - a.n + {MIN_WORDS} GROUP BY ALL
), win AS (
  SELECT e.doc_id, e.k, e.z, string_agg(s.line, chr(10) ORDER BY s.k) AS body FROM e JOIN s ON s.doc_id = e.doc_id AND s.k BETWEEN e.k AND e.z GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, k) AS nth FROM win
), gone AS (
  SELECT DISTINCT s.doc_id, s.pos FROM ranked r JOIN s ON s.doc_id = r.doc_id AND s.k BETWEEN r.k AND r.z WHERE r.nth > 1
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos WHERE g.pos IS NULL GROUP BY 1
)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
  CAST((SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
