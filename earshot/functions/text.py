"""Text columns: keys, word sets, segment cleaning, closest-label score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a word set drops and those it splits on.
DROPPED_CHARACTERS = r"[!?\-]+"
WORD_SEPARATORS = r"""[ ,.;:"']+"""

# Every line boundary of Unicode text.
LINE_BREAKS = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"

# Every character that counts as blank at the ends of a line.
BLANKS = (
    "\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

NON_WORD = r"[^\p{L}\p{N}_]+"
NON_ALPHANUMERIC = r"[^\p{L}\p{N}]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def comment_id(text: Column) -> Column:
    """Join key of a comment: a fixed-width digest, so long texts are never shuffled as keys."""
    return F.sha2(text, 256)


def word_set(text: Column) -> Column:
    """Distinct words of a text, case kept; separators at the ends leave an empty word."""
    return F.array_distinct(
        F.split(F.regexp_replace(text, DROPPED_CHARACTERS, ""), WORD_SEPARATORS)
    )


def lower_tokens(text: Column) -> Column:
    """Distinct lower-cased runs of letters, digits and underscores."""
    words = F.array_distinct(F.split(F.lower(text), NON_WORD))
    return F.filter(words, lambda w: w != "")


def _share(whole: Column, covered: Column) -> Column:
    return F.lit(1.0) - (whole - covered) / whole


def coverage(whole: Column, part: Column) -> Column:
    """Share of the words in set ``whole`` that also occur in set ``part``."""
    return _share(F.size(whole), F.size(whole) - F.size(F.array_except(whole, part)))


def clean_segments(text: Column) -> Column:
    """Lines of a completion without blanks, dashes and quotes at their ends, repeats and empties."""
    lines = F.split(text, LINE_BREAKS)
    bare = F.transform(
        lines,
        lambda s: F.btrim(F.btrim(F.btrim(s, F.lit(BLANKS)), F.lit("-")), F.lit('"')),
    )
    return F.filter(F.array_distinct(bare), lambda s: s != "")


def segment_structs(comment: Column, completion: Column) -> Column:
    """Array of (Segment, SegmentNumber, Coverage) for one comment.

    Word sets are built once and stay inside the row: only segments and their figures are
    exploded. Segments quote the comment, so the words that are *not* in it are few; a segment's
    covered words are its own without those, which keeps the work linear in the text where
    comparing every segment with the whole comment would be quadratic.
    """

    def figures(whole: Column, parts: Column) -> Column:
        every_word = F.flatten(F.transform(parts, lambda p: p["words"]))
        return bind(
            F.array_except(every_word, whole),
            lambda foreign: F.transform(
                parts,
                lambda p, i: F.struct(
                    p["Segment"].alias("Segment"),
                    i.cast("long").alias("SegmentNumber"),
                    _share(F.size(whole), F.size(F.array_except(p["words"], foreign))).alias(
                        "Coverage"
                    ),
                ),
            ),
        )

    parts = F.transform(
        clean_segments(completion),
        lambda s: F.struct(s.alias("Segment"), word_set(s).alias("words")),
    )
    return bind(word_set(comment), lambda whole: bind(parts, lambda p: figures(whole, p)))


def normalised(text: Column) -> Column:
    """Lower case, everything but letters and digits turned to single blanks, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), NON_ALPHANUMERIC, " "))


def label_score(raw: Column, entry: Column) -> Column:
    """Likeness of two normalised labels in [0, 1].

    1 for equal labels, 0.9 when one holds the other as whole words, else one minus the edit
    distance over the longer length.
    """
    padded_raw = F.concat(F.lit(" "), raw, F.lit(" "))
    padded_entry = F.concat(F.lit(" "), entry, F.lit(" "))
    longest = F.greatest(F.length(raw), F.length(entry))
    holds = (F.length(raw) > 0) & (
        F.contains(padded_raw, padded_entry) | F.contains(padded_entry, padded_raw)
    )
    return (
        F.when(raw == entry, F.lit(1.0))
        .when(holds, F.lit(0.9))
        .otherwise(F.lit(1.0) - F.levenshtein(raw, entry) / longest)
    )


def closest_match(raw: Column, entries: list[str]) -> Column:
    """struct(score, label) of the best entry of a closed list; ties go to the earlier entry, and null has none."""
    listed = F.array(*[F.lit(e) for e in entries])
    best = bind(
        normalised(raw),
        lambda r: F.array_max(
            F.transform(
                listed,
                lambda e, i: F.struct(
                    F.round(label_score(r, normalised(e)), 9).alias("score"),
                    (-i).alias("rank"),
                    e.alias("label"),
                ),
            )
        ),
    )
    return F.when(raw.isNotNull(), bind(best, lambda b: F.struct(b["score"].alias("score"), b["label"].alias("label"))))


def closest_label(raw: Column, entries: list[str], floor: float = 0.0) -> Column:
    """Best entry of a closed list; ties go to the earlier entry, below ``floor`` null.

    The list is a literal of the plan, so no join is needed; an exact entry (the usual case)
    is answered without scoring.
    """
    scored = bind(closest_match(raw, entries), lambda b: F.when(b["score"] >= F.lit(floor), b["label"]))
    return F.when(raw.isNull(), F.lit(None).cast("string")).when(
        raw.isin(entries), raw
    ).otherwise(scored)
