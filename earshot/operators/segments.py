"""Splitting comments into segments, measuring coverage, and the segment cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.text import segment_structs
from earshot.operators.shape import conform
from earshot.schemas import SEGMENTS


def cumulative_coverage(segments: DataFrame) -> DataFrame:
    """Running coverage per comment; a group is the lines of one text, never more."""
    upto = (
        Window.partitionBy("CommentId")
        .orderBy("SegmentNumber")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return segments.withColumn("CumulativeCoverage", F.sum("Coverage").over(upto))


def explode_segments(completed: DataFrame) -> DataFrame:
    """One row per segment of (CommentId, SurveyComment, content); no shuffle."""
    return completed.select(
        "CommentId",
        F.inline(segment_structs(F.col("SurveyComment"), F.get("content", F.lit(0)))),
    )


def segment_comments(completed: DataFrame, run_date: int) -> DataFrame:
    """Segments with coverage and running coverage, stamped with the run date."""
    return conform(
        cumulative_coverage(explode_segments(completed)).withColumn("RunDateId", F.lit(run_date)),
        SEGMENTS,
    )


def segment_cache_hits(cache: DataFrame, batch: DataFrame) -> DataFrame:
    """Cached segments of the comments in this batch."""
    return cache.join(batch.select("CommentId").distinct(), "CommentId", "left_semi")


def segment_cache_misses(cache: DataFrame, batch: DataFrame) -> DataFrame:
    """Comments of this batch that still have to be segmented."""
    return batch.join(cache.select("CommentId").distinct(), "CommentId", "left_anti")


def segment_cache_news(cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """New segments of comments the cache does not hold: what has to be added to it."""
    return fresh.join(cache.select("CommentId").distinct(), "CommentId", "left_anti")


def extend_segment_cache(cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """The cache with the new segments of comments it did not hold."""
    return cache.unionByName(segment_cache_news(cache, fresh))
