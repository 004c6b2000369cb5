"""Label counts and drift, duplicates, frame comparison, balances, metrics, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from earshot.operators.skew import numbered, repeat_rows
from earshot.schemas import LABEL_COLUMNS

NOT_LABELED = "Not Labeled"
LABEL_PAIR = ["LabelType", "LabelValue"]


def label_counts(report: DataFrame, run_date: int) -> DataFrame:
    """Distinct responses per value of each label column, in one pass over the report.

    The distinct count is spread by response first, so a value that covers most rows is still
    counted by all tasks.
    """
    labelled = report.select(
        "FeedbackId", *[F.coalesce(c, F.lit(NOT_LABELED)).alias(c) for c in LABEL_COLUMNS]
    )
    return (
        labelled.unpivot(["FeedbackId"], LABEL_COLUMNS, *LABEL_PAIR)
        .groupBy(*LABEL_PAIR)
        .agg(F.count_distinct("FeedbackId").alias("DistinctResponseCount"))
        .select(F.lit(run_date).alias("DIM_DateId"), *LABEL_PAIR, "DistinctResponseCount")
    )


def number_responses(ids: DataFrame, known: DataFrame) -> DataFrame:
    """(FeedbackId, Number) of all responses: known ones keep their number, new ones follow in an order of their own."""
    new = ids.select("FeedbackId").distinct().join(known.select("FeedbackId"), "FeedbackId", "left_anti")
    last = F.coalesce(known.agg(F.max("Number")).scalar(), F.lit(0))
    return known.unionByName(numbered(new).select("FeedbackId", (F.col("RowNumber") + last).alias("Number")))


def label_bitmaps(report: DataFrame, numbers: DataFrame, by: Sequence[str] = ("DIM_DateId",)) -> DataFrame:
    """The responses of each label value as bitmaps over their numbers, for each value of ``by``.

    Bitmaps of 32,768 numbers are a row each, so a value that covers most rows is spread over many rows. They can be stored
    and merged: a day is added without reading the rows of others.
    """
    rows = report.select("FeedbackId", *by, *[F.coalesce(c, F.lit(NOT_LABELED)).alias(c) for c in LABEL_COLUMNS])
    long = rows.join(numbers, "FeedbackId").unpivot(["Number", *by], LABEL_COLUMNS, *LABEL_PAIR)
    return long.groupBy(*by, *LABEL_PAIR, F.bitmap_bucket_number("Number").alias("Bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("Number")).alias("Bitmap")
    )


def merged_label_counts(bitmaps: DataFrame, run_date: int) -> DataFrame:
    """Distinct responses per label value over all bitmaps given; what ``label_counts`` gives for all their rows."""
    merged = bitmaps.groupBy(*LABEL_PAIR, "Bucket").agg(F.bitmap_or_agg("Bitmap").alias("Bitmap"))
    counts = merged.groupBy(*LABEL_PAIR).agg(F.sum(F.bitmap_count("Bitmap")).alias("DistinctResponseCount"))
    return counts.select(F.lit(run_date).alias("DIM_DateId"), *LABEL_PAIR, "DistinctResponseCount")


def label_drift(prior: DataFrame, current: DataFrame, run_date: int) -> DataFrame:
    """Current counts with an issue flag against the previous snapshot.

    A named label must not lose responses (vanishing counts as zero) and ``Not Labeled`` must
    not gain any; a named label seen for the first time is no issue.
    """
    old = prior.select(*LABEL_PAIR, F.col("DistinctResponseCount").alias("_old"))
    new = current.select(*LABEL_PAIR, F.col("DistinctResponseCount").alias("_new"))
    was, now = F.coalesce("_old", F.lit(0)), F.coalesce("_new", F.lit(0))
    return old.join(new, LABEL_PAIR, "full_outer").select(
        F.lit(run_date).alias("DIM_DateId"),
        *LABEL_PAIR,
        now.alias("DistinctResponseCount"),
        F.when(F.col("LabelValue") == NOT_LABELED, now > was).otherwise(now < was).alias("IssueFlag"),
    )


def backfill_probe(dim: DataFrame, run_date: int) -> DataFrame:
    """One row: the oldest processing date and whether it is the run date."""
    return dim.agg(F.min("ProcessingDate").alias("OldestProcessingDate")).withColumn(
        "IsBackfill", F.coalesce(F.col("OldestProcessingDate") == run_date, F.lit(False))
    )


def silence_backfill(flags: DataFrame, dim: DataFrame, run_date: int) -> DataFrame:
    """Force the issue flags to false while everything is being processed for the first time."""
    probe = backfill_probe(dim, run_date).select("IsBackfill").scalar()
    return flags.withColumn("IssueFlag", F.col("IssueFlag") & ~probe)


def latest_snapshot(qc: DataFrame) -> DataFrame:
    """Rows of the most recent date."""
    return qc.filter(F.col("DIM_DateId") == qc.agg(F.max("DIM_DateId")).scalar())


def append_qc(prior: DataFrame, current: DataFrame, survey_type: str) -> DataFrame:
    """Earlier snapshots plus the current one, for one survey type."""
    return prior.unionByName(current.withColumn("SurveyType", F.lit(survey_type)))


def drift_alerts(qc: DataFrame, run_date: int) -> DataFrame:
    """Flagged rows of the run date and the matching rows of the snapshot before it."""
    issues = qc.filter(F.col("IssueFlag") & (F.col("DIM_DateId") == run_date))
    earlier = latest_snapshot(qc.filter(F.col("DIM_DateId") < run_date))
    pairs = issues.select("SurveyType", *LABEL_PAIR).distinct()
    return issues.unionByName(earlier.join(pairs, ["SurveyType", *LABEL_PAIR], "left_semi").select(*issues.columns))


# -- bags of rows


def find_duplicates(df: DataFrame) -> DataFrame:
    """Surplus copies of identical rows: every row once less than it occurs."""
    surplus = (
        df.groupBy(*df.columns)
        .agg((F.count(F.lit(1)) - 1).alias("_surplus"))
        .filter(F.col("_surplus") > 0)
    )
    return repeat_rows(surplus, "_surplus").drop("_copy")


def _signed_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Occurrences of each row on either side; copies are combined before the shuffle."""
    sides = left.withColumn("_side", F.lit(0)).unionByName(right.withColumn("_side", F.lit(1)))
    return sides.groupBy(*left.columns).agg(
        F.count_if(F.col("_side") == 0).alias("_left"),
        F.count_if(F.col("_side") == 1).alias("_right"),
    )


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag difference: each row as often as it occurs more on the left than on the right."""
    more = (
        _signed_counts(left, right)
        .withColumn("_more", F.col("_left") - F.col("_right"))
        .filter(F.col("_more") > 0)
        .drop("_left", "_right")
    )
    return repeat_rows(more, "_more").drop("_copy")


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set difference."""
    return left.subtract(right)


def frames_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows only on either side, counted with their copies, and whether all is equal."""
    if left.schema.simpleString() != right.schema.simpleString():
        return left.sparkSession.range(1).select(
            F.lit(None).cast("long").alias("OnlyLeft"),
            F.lit(None).cast("long").alias("OnlyRight"),
            F.lit(False).alias("Equal"),
        )
    gap = F.col("_left") - F.col("_right")
    return (
        _signed_counts(left, right)
        .agg(
            F.coalesce(F.sum(F.greatest(gap, F.lit(0))), F.lit(0)).alias("OnlyLeft"),
            F.coalesce(F.sum(F.greatest(-gap, F.lit(0))), F.lit(0)).alias("OnlyRight"),
        )
        .withColumn("Equal", (F.col("OnlyLeft") == 0) & (F.col("OnlyRight") == 0))
    )


# -- balances and metrics


def conservation_check(
    stage: str, check: str, whole: Sequence[DataFrame], parts: Sequence[DataFrame]
) -> DataFrame:
    """One row stating whether the rows of ``whole`` equal those of all ``parts`` together."""
    marked = [f.select(F.lit(True).alias("_whole")) for f in whole]
    marked += [f.select(F.lit(False).alias("_whole")) for f in parts]
    return reduce(DataFrame.unionAll, marked).agg(
        F.count_if("_whole").alias("Expected"), F.count_if(~F.col("_whole")).alias("Actual")
    ).select(
        F.lit(stage).alias("Stage"),
        F.lit(check).alias("Check"),
        "Expected",
        "Actual",
        (F.col("Expected") == F.col("Actual")).alias("Ok"),
    )


def run_metrics(
    df: DataFrame, stage: str, metrics: Mapping[str, Column], run_date: int
) -> DataFrame:
    """Named aggregates of a frame as long rows (Stage, Metric, Value, RunDateId)."""
    values = df.agg(*[c.cast("double").alias(n) for n, c in metrics.items()])
    return values.unpivot([], list(metrics), "Metric", "Value").select(
        F.lit(stage).alias("Stage"), "Metric", "Value", F.lit(run_date).alias("RunDateId")
    )


def observed(df: DataFrame, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """Collect metrics while the frame is written, without a pass of its own."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen


def source_profile(flagged: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: rows and distinct comments of the source, eligible rows, nonresponses.

    ``flagged`` has one row per eligible comment with its response count and nonresponse flag,
    ``fact`` is the source with comment ids.
    """
    silent = F.col("IsNonresponse")
    whole = fact.agg(
        F.count(F.lit(1)).alias("SourceRows"),
        F.count_distinct("CommentId").alias("SourceDistinctComments"),
    )
    eligible = flagged.agg(
        F.coalesce(F.sum("ResponseCount"), F.lit(0)).alias("EligibleRows"),
        F.count(F.lit(1)).alias("EligibleDistinctComments"),
        F.coalesce(F.sum(F.when(silent, F.col("ResponseCount"))), F.lit(0)).alias("NonresponseRows"),
        F.count_if(silent).alias("DistinctNonresponses"),
    )
    return whole.select(
        "*", *[eligible.select(c).scalar().alias(c) for c in eligible.columns]
    )
