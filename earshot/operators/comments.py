"""The dimension of distinct comments: statistics, nonresponses, upkeep, work queue.

Everything here works on one row per comment. Copies of a comment are combined before the
shuffle, so a comment that makes up most of the fact costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.text import lower_tokens
from earshot.operators.shape import conform
from earshot.operators.skew import hot_keys, lookup_join, skew_join
from earshot.schemas import COMMENT_DIM, COMMENT_STATE
from earshot.session import persist_table

COMMENT_KEY = ["SurveyType", "CommentId"]
# Bytes of the dictionary's filter: about ten for each word, within these bounds.
LEAST_SLOTS, MOST_SLOTS = 1 << 12, 1 << 23


def comment_stats(responses: DataFrame) -> DataFrame:
    """First date, last date and number of responses per comment, in one aggregate.

    Responses that carry the ``CharacterCount`` of their text in place of the text keep texts out of the exchange.
    """
    # The text is part of the key: one comment id has one text, and fixed-width buffers need no sort of texts.
    body = [c for c in ("SurveyComment", "CharacterCount") if c in responses.columns]
    return responses.groupBy(*COMMENT_KEY, *body).agg(
        F.min("DIM_DateId").alias("FirstResponseDate"),
        F.max("DIM_DateId").alias("LastResponseDate"),
        F.count(F.lit(1)).alias("ResponseCount"),
    )


def hot_comments(dim: DataFrame, nonresponses: DataFrame | None = None, **limits) -> DataFrame:
    """Comments that hold too many responses, read off the stored response counts.

    The list drives the spreading in every join from responses to comments; see
    :func:`earshot.operators.skew.hot_keys` for its bound.
    """
    counts = dim.select("CommentId", "ResponseCount")
    if nonresponses is not None:
        counts = counts.unionByName(nonresponses.select("CommentId", "ResponseCount"))
    return hot_keys(counts, ["CommentId"], weight="ResponseCount", **limits)


def with_character_count(df: DataFrame) -> DataFrame:
    """Add the length of the text; rows without texts have it already."""
    return df.withColumn("CharacterCount", F.length("SurveyComment").cast("long")) if "SurveyComment" in df.columns else df


def word_slots(words: DataFrame, least: int = LEAST_SLOTS, most: int = MOST_SLOTS) -> bytes:
    """A bloom filter of the words of a one-column frame: one byte per slot, at most ``most`` bytes whatever the number of words."""
    column = F.col(words.columns[0])
    size = least
    while size < min(most, 10 * words.count()):
        size *= 2
    found = words.select(F.explode(_slots(column, size)).alias("slot")).distinct().toPandas()["slot"]
    out = bytearray(size)
    for slot in found:
        out[slot] = 1
    return bytes(out)


def _slots(word: Column, size: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(word, F.lit(k)), F.lit(size)).cast("int") for k in range(3)])


def likely_words(text: Column, slots: bytes) -> Column:
    """The text's tokens that the filter holds: all dictionary words, and a few others."""
    held = F.lit(slots)
    inside = lambda slot: F.substring(held, slot + 1, 1) == F.lit(b"\x01")
    return F.filter(lower_tokens(text), lambda w: F.forall(_slots(w, len(slots)), inside))


def _worded(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Ids of comments with a dictionary word.

    A filter of the dictionary is applied inside the row. A comment without a likely word has none; of the others one likely word
    each is looked up, which settles nearly all, and only comments whose first likely word was none have the rest looked up.
    """
    words = persist_table(dictionary.select(F.col(dictionary.columns[0]).alias("word")).distinct(), "words")
    slots = word_slots(words)
    texts = comments.select("CommentId", likely_words(F.col("SurveyComment"), slots).alias("likely"))
    first = texts.select("CommentId", F.get("likely", F.lit(0)).alias("word"), F.size("likely").alias("n")).filter("n > 0")
    first = persist_table(first, "first-words")
    sure = lookup_join(first, words, ["word"], "left_semi").select("CommentId")
    unsure = first.filter("n > 1").join(sure, "CommentId", "left_anti").select("CommentId")
    rest = lookup_join(comments.select("CommentId", "SurveyComment"), unsure, ["CommentId"], "left_semi")
    rest = rest.select("CommentId", F.explode(likely_words(F.col("SurveyComment"), slots)).alias("word"))
    found = lookup_join(rest, words, ["word"], "left_semi").select("CommentId").distinct()
    return persist_table(sure.unionByName(found).distinct(), "comments-worded")


def nonresponse_flags(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(CommentId, IsNonresponse) of one row per comment; a comment's text does not travel."""
    short = comments.select("CommentId", (F.length("SurveyComment") < 2).alias("_short"))
    worded = _worded(comments, dictionary).withColumn("_worded", F.lit(True))
    flag = F.col("_worded").isNull() | F.col("_short")
    return short.join(worded, "CommentId", "left").select("CommentId", flag.alias("IsNonresponse"))


def nonresponse_split(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Flag comments that are shorter than two characters or hold no dictionary word.

    ``comments`` is one row per comment; ``dictionary`` has the words in its first column.
    """
    worded = _worded(comments, dictionary).withColumn("_worded", F.lit(True))
    return (
        comments.join(worded, "CommentId", "left")
        .withColumn(
            "IsNonresponse", F.col("_worded").isNull() | (F.length("SurveyComment") < 2)
        )
        .drop("_worded")
    )


def drop_removed_comments(known: DataFrame, responses: DataFrame) -> DataFrame:
    """Known comments that still occur in the fact."""
    return known.join(responses.select(*COMMENT_KEY).distinct(), COMMENT_KEY, "left_semi")


def repeat_responses(responses: DataFrame, known: DataFrame) -> DataFrame:
    """Known comments that occur again, with dates and counts taken afresh from the fact."""
    kept = known.select(*COMMENT_KEY, "TokenCount", "ProcessingDate", "ReportingDate")
    return conform(
        with_character_count(comment_stats(responses)).join(kept, COMMENT_KEY), COMMENT_DIM
    )


def new_responses(
    responses: DataFrame, known: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Fact rows whose comment is not known yet."""
    return skew_join(
        responses, known.select(*COMMENT_KEY), COMMENT_KEY, "left_anti", ["FeedbackId"], hot
    )


def upsert_comment_dim(stats: DataFrame, known: DataFrame) -> DataFrame:
    """New state of the dimension: every comment of the fact, with the work state it had.

    ``stats`` comes from :func:`comment_stats`. Comments gone from the fact drop out, repeated
    ones get fresh dates and counts, new ones start without a work state. Statistics without
    texts give the work state alone.
    """
    kept = known.select(*COMMENT_KEY, "TokenCount", "ProcessingDate", "ReportingDate")
    shape = COMMENT_DIM if "SurveyComment" in stats.columns else COMMENT_STATE
    return conform(with_character_count(stats).join(kept, COMMENT_KEY, "left"), shape)


def work_queue(dim: DataFrame, batch_size: int | None) -> DataFrame:
    """Unprocessed comments, latest and then most frequent first, up to the batch size."""
    waiting = dim.filter(F.col("ProcessingDate").isNull())
    if batch_size is None:
        return waiting
    return waiting.orderBy(
        F.desc("LastResponseDate"), F.desc("ResponseCount"), F.asc("CommentId")
    ).limit(batch_size)


def unprocessed_work(buffer: DataFrame, dim: DataFrame) -> DataFrame:
    """Buffer rows whose comment has not been processed."""
    open_ids = dim.filter(F.col("ProcessingDate").isNull()).select("CommentId").distinct()
    return buffer.join(open_ids, "CommentId", "left_semi")


def mark_processed(dim: DataFrame, done: DataFrame, run_date: int) -> DataFrame:
    """Set ``ProcessingDate`` on the comments of ``done`` (finished, or fuzzy duplicates); earlier dates stay."""
    ids = done.select("CommentId").distinct().withColumn("_done", F.lit(True))
    return (
        dim.join(ids, "CommentId", "left")
        .withColumn(
            "ProcessingDate",
            F.coalesce("ProcessingDate", F.when(F.col("_done"), F.lit(run_date))),
        )
        .select(*dim.columns)
    )


def mark_reported(dim: DataFrame, published: DataFrame, run_date: int) -> DataFrame:
    """Set ``ReportingDate`` where a comment is processed, not yet reported, and in ``published``."""
    ids = published.select("CommentId").distinct().withColumn("_published", F.lit(True))
    due = F.col("ProcessingDate").isNotNull() & F.col("_published")
    return (
        dim.join(ids, "CommentId", "left")
        .withColumn("ReportingDate", F.coalesce("ReportingDate", F.when(due, F.lit(run_date))))
        .select(*dim.columns)
    )
