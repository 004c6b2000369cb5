"""Pairs of texts within a number of edits, by partition signatures.

A known text is cut into one more piece than edits are allowed, so at least one piece survives in any text within the limit. Pieces
have the width floor(length / pieces), which is one of two or three values for all known texts that a new text can be
compared with. A new text is probed for every such width at the few places where a surviving piece can be: let the
surviving piece be the first one, i, before which there are exactly i edits (there is one, by counting); then it has moved by at most i
places, and by no more than the edits that are left allow for the rest of the two lengths. Pieces and probes meet by a hash that
holds width, number and characters; pairs are confirmed by the edit distance itself: of long texts by how far each diagonal of the table
gets with so many edits (Landau and Vishkin), which costs their length and the square of the limit, not the square of their length.

A known text costs ``edits + 1`` rows and a new one about ``edits ** 2`` rows for each width, whatever the number of texts. Pieces that many
known texts share (a greeting, a signature) are spread over several tasks.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.operators.skew import hot_keys, skew_join
from earshot.session import persist_table

# The task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pieces shorter than this are in nearly every text; texts that would have them are left to other ways.
LEAST_PIECE = 4
# Beyond this limit a new text would have too many probes.
MOST_EDITS = 32
# Texts of this many characters for each edit allowed, and of LONG_TEXT, are compared by diagonals; a table of shorter ones is filled sooner.
LONG_PER_EDIT, LONG_TEXT = 32, 2048
# Characters of a diagonal compared at first, and at most, at a time.
FIRST_STRIDE, LAST_STRIDE = 16, 4096


def least_length(max_edits: int) -> int:
    """New texts from this length on have only partners with pieces of ``LEAST_PIECE`` characters or more."""
    return (max_edits + 1) * LEAST_PIECE + max_edits


def piece_keys(text: Column, max_edits: int) -> Column:
    """Hashes of a known text's pieces."""
    pieces = max_edits + 1
    width = F.floor(F.length(text) / pieces).cast("int")
    one = lambda i: F.xxhash64(width, i, F.substring(text, i * width + 1, width))
    return F.transform(F.sequence(F.lit(0), F.lit(max_edits)), one)


def probe_keys(text: Column, size: Column, max_edits: int) -> Column:
    """Hashes of all places of a new text, of ``size`` characters, where a piece of a known one can have survived."""
    pieces = max_edits + 1

    def places(width: Column, i: Column) -> Column:
        # The lengths that known texts with pieces of this width can have, as differences from this text's length.
        most = F.least(size - width * pieces, F.lit(max_edits))
        least = F.greatest(size - width * pieces - max_edits, F.lit(-max_edits))
        first = F.greatest(-i, least - (max_edits - i), -i * width)
        last = F.least(i, most + (max_edits - i), size - (i + 1) * width)
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    def of_piece(width: Column, i: Column) -> Column:
        # The part that holds all places is cut out first, so that a long text is not walked through for each place.
        start = F.greatest(i * width - max_edits, F.lit(0))
        part = F.struct(F.substring(text, start + 1, width + 2 * max_edits).alias("text"), start.alias("start"))
        key = lambda p, s: F.xxhash64(width, i, F.substring(p["text"], i * width + s - p["start"] + 1, width))
        return F.flatten(F.transform(F.array(part), lambda p: F.transform(places(width, i), lambda s: key(p, s))))

    def of_width(width: Column) -> Column:
        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(max_edits)), lambda i: of_piece(width, i)))

    narrow = F.greatest(F.floor((size - max_edits) / pieces).cast("int"), F.lit(LEAST_PIECE))
    wide = F.floor((size + max_edits) / pieces).cast("int")
    widths = F.when(narrow <= wide, F.sequence(narrow, wide)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.flatten(F.transform(widths, of_width)))


def _points(text: bytes, end: int) -> np.ndarray:
    """Code points of a text, then ``LAST_STRIDE`` times a number that is none."""
    points = np.frombuffer(bytes(text).decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), "<u4")
    return np.concatenate([points, np.full(LAST_STRIDE, end, "<u4")])


def _bag(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often single characters and three in a row occur, counted in a few slots."""
    p = points[: len(points) - LAST_STRIDE]
    mixed = p[:-2] * np.uint32(0x9E3779B1) ^ p[1:-1] * np.uint32(0x85EBCA6B) ^ p[2:] * np.uint32(0xC2B2AE35)
    return np.bincount(p & 255, minlength=256), np.bincount(mixed >> np.uint32(20), minlength=4096)


def _bags_apart(a: np.ndarray, b: np.ndarray, max_edits: int) -> bool:
    """Whether the counts alone rule out so few edits: one edit takes or adds one character, and three runs of three at most."""
    for mine, theirs, each in zip(_bag(a), _bag(b), (1, 3), strict=True):
        gap = mine - theirs
        if max(gap[gap > 0].sum(), -gap[gap < 0].sum()) > each * max_edits:
            return True
    return False


def within_edits(left: bytes, right: bytes, max_edits: int) -> bool:
    """Whether two texts in UTF-8 are at most ``max_edits`` edits apart."""
    a, b = _points(left, 0xFFFFFFFF), _points(right, 0xFFFFFFFE)
    n, m = len(a) - LAST_STRIDE, len(b) - LAST_STRIDE
    goal, middle = m - n, max_edits + 1
    if abs(goal) > max_edits or _bags_apart(a, b, max_edits):
        return False
    # Place d + middle: how many characters of ``left`` are behind one who is that many places further in ``right`` by d.
    far = np.full(2 * middle + 1, np.iinfo(np.int32).min, np.int64)
    for edits in range(max_edits + 1):
        # Diagonals from which the goal's cannot be reached any more are left out.
        spare = max_edits - edits
        d = np.arange(max(-edits, goal - spare), min(edits, goal + spare) + 1)
        at = d + middle
        if edits:
            reached = np.minimum(np.maximum(np.maximum(far[at] + 1, far[at + 1] + 1), far[at - 1]), np.minimum(n, m - d))
        else:
            reached = np.zeros(len(d), np.int64)
        live, stride = np.flatnonzero(reached >= 0), FIRST_STRIDE
        while len(live):
            place = reached[live, None] + np.arange(stride)
            same = a[place] == b[place + d[live, None]]
            run = np.where(same.all(axis=1), stride, same.argmin(axis=1))
            reached[live] += run
            live, stride = live[run == stride], min(4 * stride, LAST_STRIDE)
        far[at] = reached
        if far[goal + middle] >= n:
            return True
    return False


def spelled_alike(left: str, right: str, max_edits: int) -> Column:
    """Whether two columns of texts are at most ``max_edits`` edits apart."""
    size = F.greatest(F.length(left), F.length(right))
    comparable = F.abs(F.length(left) - F.length(right)) <= max_edits
    long = comparable & (size >= max(LONG_TEXT, LONG_PER_EDIT * max_edits))

    @F.pandas_udf("boolean")
    def by_diagonals(mine: pd.Series, theirs: pd.Series) -> pd.Series:
        return pd.Series([a is not None and within_edits(a, b, max_edits) for a, b in zip(mine, theirs, strict=True)])

    sent = lambda c: F.when(long, F.col(c).cast("binary"))
    short = F.levenshtein(F.when(~long, F.col(left)), F.col(right), max_edits) >= 0
    return comparable & (by_diagonals(sent(left), sent(right)) | F.coalesce(short, F.lit(False)))


def of_like_length(new: DataFrame, known: DataFrame, max_edits: int) -> DataFrame:
    """New texts for which a known one of nearly the same length exists; only lengths and ids travel."""
    there = known.select(F.length("SurveyComment").alias("_length")).distinct()
    size = F.length("SurveyComment")
    wanted = new.select("CommentId", F.explode(F.sequence(size - max_edits, size + max_edits)).alias("_length"))
    return new.join(wanted.join(there, "_length", "left_semi").select("CommentId").distinct(), "CommentId", "left_semi")


def candidates(new: DataFrame, known: DataFrame, max_edits: int, **limits) -> DataFrame:
    """(CommentId, KnownCommentId) of all pairs that share a piece and differ in length by at most the limit; every close pair is among them.

    Holds for new texts of ``least_length`` or more; known ones that are too short to be close to such are left out.
    """
    size = F.length("SurveyComment")
    kept = known.filter(size >= (max_edits + 1) * LEAST_PIECE)
    pieces = persist_table(
        kept.select("KnownCommentId", size.alias("_known"), F.explode(piece_keys(F.col("SurveyComment"), max_edits)).alias("_piece_key")), "edit-pieces"
    )
    sized = of_like_length(new, kept, max_edits).select("CommentId", "SurveyComment", size.alias("_new"))
    probes = sized.select("CommentId", "_new", F.explode(probe_keys(F.col("SurveyComment"), F.col("_new"), max_edits)).alias("_piece_key"))
    hot = hot_keys(pieces, ["_piece_key"], **limits)
    met = skew_join(pieces, probes, ["_piece_key"], "inner", ["KnownCommentId"], hot)
    return met.filter(F.abs(F.col("_known") - F.col("_new")) <= max_edits).select("CommentId", "KnownCommentId").distinct()


def close_pairs(new: DataFrame, known: DataFrame, max_edits: int, **limits) -> DataFrame:
    """(CommentId, KnownCommentId) of all pairs within ``max_edits`` edits, for new texts of ``least_length`` or more.

    ``new`` has CommentId and SurveyComment, ``known`` KnownCommentId and SurveyComment, one row per comment.
    """
    pairs = persist_table(candidates(new, known, max_edits, **limits), "edit-candidates")
    theirs = known.select("KnownCommentId", F.col("SurveyComment").alias("_theirs"))
    texts = pairs.join(theirs, "KnownCommentId").join(new.select("CommentId", "SurveyComment"), "CommentId")
    return texts.filter(spelled_alike("SurveyComment", "_theirs", max_edits)).select("CommentId", "KnownCommentId")
