"""Intake of what changed: marks of the fact's partitions, counts that can be replaced, state of touched comments.

A partition (a day of the fact) has a mark; partitions whose mark is as it was are not looked at. Of each partition the number of
responses per comment is kept. When a partition changes, its old counts are taken out and new ones put in; only comments in either
are touched, and their dates and counts come from the kept counts of the other partitions and the new ones. Texts take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.comments import COMMENT_KEY
from earshot.operators.shape import conform
from earshot.operators.skew import lookup_join
from earshot.schemas import COMMENT_STATE

PARTITION = "DIM_DateId"


def partition_marks(rows: DataFrame, settings: str = "") -> DataFrame:
    """(Partition, Mark): count and order-free digests of a partition's responses and comments, after the settings they were chosen by."""
    one = F.xxhash64("FeedbackId", "SurveyComment")
    two = F.xxhash64("SurveyComment", "FeedbackId", F.lit(1))
    return rows.groupBy(F.col(PARTITION).alias("Partition")).agg(
        F.concat_ws(
            ":", F.lit(settings), F.count(F.lit(1)), F.bit_xor(one), F.sum(one.cast("decimal(20,0)")), F.sum(two.cast("decimal(20,0)"))
        ).alias("Mark")
    )


def changed_partitions(now: DataFrame, before: DataFrame) -> DataFrame:
    """Partitions that are new, gone or different."""
    old = before.select("Partition", F.col("Mark").alias("_before"))
    both = now.join(old, "Partition", "full")
    return both.filter(~F.col("Mark").eqNullSafe(F.col("_before"))).select("Partition")


def counts_by_partition(rows: DataFrame) -> DataFrame:
    """Responses per comment and partition, with the comment's text."""
    return rows.groupBy(*COMMENT_KEY, "SurveyComment", PARTITION).agg(F.count(F.lit(1)).alias("ResponseCount"))


def touched_comments(old: DataFrame, fresh: DataFrame) -> DataFrame:
    """Comments in the old or the new rows of the changed partitions."""
    return old.select("CommentId").unionByName(fresh.select("CommentId")).distinct()


def touched_stats(kept: DataFrame, fresh: DataFrame, touched: DataFrame) -> DataFrame:
    """Dates and counts of the touched comments that are still in the fact; ``kept`` are the unchanged partitions' counts."""
    columns = [*COMMENT_KEY, PARTITION, "ResponseCount"]
    rows = lookup_join(kept.select(*columns), touched, ["CommentId"], "left_semi").unionByName(fresh.select(*columns))
    return rows.groupBy(*COMMENT_KEY).agg(
        F.min(PARTITION).alias("FirstResponseDate"), F.max(PARTITION).alias("LastResponseDate"), F.sum("ResponseCount").alias("ResponseCount")
    )


def refreshed_state(known: DataFrame, stats: DataFrame, touched: DataFrame, sizes: DataFrame) -> DataFrame:
    """The work state with touched comments as the fact has them now: gone ones drop out, new ones start without a work state.

    ``stats`` are the touched responses, ``sizes`` (CommentId, CharacterCount) those of them that were not known.
    """
    kept = known.select(*COMMENT_KEY, "TokenCount", "ProcessingDate", "ReportingDate", F.col("CharacterCount").alias("_known"))
    again = (
        stats.join(kept, COMMENT_KEY, "left").join(sizes.select("CommentId", F.col("CharacterCount").alias("_new")), "CommentId", "left")
        .withColumn("CharacterCount", F.coalesce("_known", "_new"))
    )
    untouched = lookup_join(known, touched, ["CommentId"], "left_anti")
    return untouched.select(*COMMENT_STATE.names).unionByName(conform(again, COMMENT_STATE))
