"""Rebuilding the reporting fact table.

A popular comment can make up a third of all responses, so every join from responses to
comments spreads the rows of hot comments, and "latest per comment" is an aggregate (combined
before the shuffle) and not a window over all responses of the comment. Rows carry the comment's
id through all joins; a text joins the rows of a new report row once, and is kept with it from then on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.shape import (
    SEGMENT_FIELDS,
    conform,
    has_empty_id,
    predicted_product_id,
    typed_backfill,
)
from earshot.operators.skew import lookup_join, newest_first, skew_join
from earshot.schemas import REPORT, REPORT_OUT, REPORT_ROWS
from earshot.session import persist_table

FACT_COLUMNS = ["DIM_DateId", "DIM_ProductMasterId", "FeedbackId", "CommentId", "Score"]
# What a report row takes from a labelled segment rather than from the response.
INHERITED = [
    "Segment", "SegmentNumber", "Coverage", "CumulativeCoverage", "SentimentLabel",
    "WorkloadLabel", "SupportLabel", "PlatformLabel", "ReportingType", "WorkloadLabel_original",
]


def processed_fact(fact: DataFrame, dim: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Responses whose comment has been processed."""
    ids = dim.filter(F.col("ProcessingDate").isNotNull()).select("CommentId").distinct()
    return skew_join(fact, ids, ["CommentId"], "left_semi", ["FeedbackId"], hot)


def nonresponse_fact(
    fact: DataFrame, nonresponses: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Responses whose comment is a nonresponse, as report rows of that kind."""
    ids = nonresponses.select("CommentId").distinct()
    rows = skew_join(fact, ids, ["CommentId"], "left_semi", ["FeedbackId"], hot)
    return typed_backfill(rows, SEGMENT_FIELDS, {"ReportingType": "Nonresponse"})


def current_report(
    processed: DataFrame, labelled: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Processed responses with the labelled segments of this run."""
    segments = labelled.drop("RunDateId", "SurveyComment")
    rows = skew_join(
        processed.select(*FACT_COLUMNS), segments, ["CommentId"], "inner", ["FeedbackId"], hot
    )
    return typed_backfill(
        rows.withColumn("WorkloadLabel_original", F.col("WorkloadLabel")),
        REPORT,
        {"ReportingType": "Report"},
    ).select(*REPORT.names)


def restate_prior_report(fact: DataFrame, prior: DataFrame) -> DataFrame:
    """Earlier report rows with date, product and score as the fact has them now.

    Rows of responses that left the fact drop out.
    """
    now = fact.select("FeedbackId", "DIM_DateId", "DIM_ProductMasterId", "Score")
    kept = prior.drop("DIM_DateId", "DIM_ProductMasterId", "Score")
    return kept.join(now, "FeedbackId").select(*prior.columns)


def distinct_rows(report: DataFrame) -> DataFrame:
    """Drop repeated rows; the comment's id stands for its text, so a text is no key."""
    return report.dropDuplicates([c for c in report.columns if c != "SurveyComment"])


def supersede_prior(current: DataFrame, prior: DataFrame, dedupe: bool = True) -> DataFrame:
    """This run's rows plus the earlier rows of (product, response) pairs it did not cover.

    The join is on the response alone, with the few products of a response as a set: the earlier
    report, the largest table, then keeps the partitioning it has from being restated. The kept rows and
    this run's have no (product, response) in common, so each side is made distinct by itself; rows
    that lack one of the two are compared as a whole.
    """
    body = F.struct(*[c for c in current.columns if c != "SurveyComment"])
    product, response = F.col("DIM_ProductMasterId"), F.col("FeedbackId")
    covered = current.groupBy("FeedbackId").agg(
        F.collect_set(product).alias("_products"), F.collect_set(F.when(product.isNull(), body)).alias("_loose")
    )
    is_covered = F.array_contains("_products", product)
    if dedupe:
        is_covered = F.coalesce(is_covered, F.lit(False)) | F.array_contains("_loose", body)
    joined = prior.join(covered, "FeedbackId", "left").filter(~F.coalesce(is_covered, F.lit(False)))
    kept = joined.select(*current.columns)
    if not dedupe:
        return current.unionByName(kept)
    named, nameless = response.isNotNull(), response.isNull()
    loose = current.filter(nameless).unionByName(prior.filter(nameless).select(*current.columns))
    return reduce(DataFrame.unionByName, [distinct_rows(current.filter(named)), distinct_rows(kept.filter(named)), distinct_rows(loose)])


def fan_out_duplicates(
    duplicate_map: DataFrame, total: DataFrame, fact: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Report rows for responses whose comment is a fuzzy duplicate of a reported one.

    The known comment's segments are made distinct first: its own responses must not multiply
    the rows of its duplicates.
    """
    due = duplicate_map.filter(F.col("ReportingDate").isNull()).select(
        "CommentId", "KnownCommentId"
    )
    known = due.select(F.col("KnownCommentId").alias("CommentId")).distinct()
    segments = (
        lookup_join(total.select(*REPORT.names), known, ["CommentId"], "left_semi", hot=hot)
        .select(F.col("CommentId").alias("KnownCommentId"), *INHERITED)
        .distinct()
    )
    per_comment = skew_join(due, segments, ["KnownCommentId"]).drop("KnownCommentId")
    rows = skew_join(
        fact.select(*FACT_COLUMNS), per_comment, ["CommentId"], "inner", ["FeedbackId"], hot
    )
    return typed_backfill(rows, REPORT).select(*REPORT.names)


def unreported_repeats(processed: DataFrame, total: DataFrame) -> DataFrame:
    """Processed responses without a row in the report."""
    return processed.join(total.select("FeedbackId").distinct(), "FeedbackId", "left_anti")


def latest_per_comment(report: DataFrame) -> DataFrame:
    """Newest report row per comment: latest date, then smallest response id and segment."""
    order = newest_first(F.col("DIM_DateId"), F.col("FeedbackId"), F.col("SegmentNumber"))
    body = [c for c in report.columns if c != "CommentId"]
    return (
        report.groupBy("CommentId")
        .agg(F.min_by(F.struct(*body), order).alias("_row"))
        .select("CommentId", *[F.col("_row")[c].alias(c) for c in body])
        .select(*report.columns)
    )


def inherit_labels(
    repeats: DataFrame, total: DataFrame, mode: str = "feedback", hot: DataFrame | None = None
) -> DataFrame:
    """Give unreported repeats the labels of the latest reported response with the same text.

    ``feedback`` takes all segments of that response; ``single`` takes one segment row.
    """
    wanted = repeats.select("CommentId").distinct()
    # A day's repeats are few: their ids are broadcast if they are small, and the report stays where it is.
    candidates = lookup_join(total.select(*REPORT.names), wanted, ["CommentId"], "left_semi", hot=hot)
    if mode == "single":
        donors = latest_per_comment(candidates)
    elif mode == "feedback":
        latest = (
            candidates.groupBy("CommentId")
            .agg(F.min(newest_first(F.col("DIM_DateId"), F.col("FeedbackId"))).alias("_best"))
            .select("CommentId", F.col("_best")["t0"].alias("FeedbackId"))
        )
        donors = candidates.join(latest, ["CommentId", "FeedbackId"], "left_semi")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    segments = donors.select("CommentId", *INHERITED).distinct()
    rows = skew_join(
        repeats.select(*FACT_COLUMNS), segments, ["CommentId"], "inner", ["FeedbackId"], hot
    )
    return typed_backfill(rows, REPORT).select(*REPORT.names)


def drop_removed_feedback(report: DataFrame, fact: DataFrame) -> DataFrame:
    """Report rows whose response is still in the fact."""
    ids = fact.select("FeedbackId").distinct()
    return report.join(ids, "FeedbackId", "left_semi")


def enrich_context(report: DataFrame, context: DataFrame) -> DataFrame:
    """Attach the user context; several contexts of one response never multiply its rows.

    Equal contexts count once; different ones are merged into the sorted union of their items.
    """
    items = F.flatten(F.transform("_all", lambda c: F.split(c, ",")))
    merged = F.array_join(F.array_sort(F.array_distinct(F.filter(items, lambda i: i != ""))), ",")
    one = (
        context.groupBy("FeedbackId")
        .agg(F.collect_set("UserContext").alias("_all"))
        .select("FeedbackId", F.when(F.size("_all") < 2, F.get("_all", F.lit(0))).otherwise(merged).alias("UserContext"))
    )
    return report.drop("UserContext").join(one, "FeedbackId", "left")


def comment_texts(present: Sequence[DataFrame], prior: DataFrame) -> DataFrame:
    """(CommentId, SurveyComment) of every comment a report row can name.

    ``present`` are the dimension and the nonresponses. A text that left the fact while its
    response stayed is taken from the earlier report; such comments are few, and are found by
    their ids before any text is read.
    """
    columns = ["CommentId", "SurveyComment"]
    known = reduce(DataFrame.unionByName, [p.select(*columns) for p in present])
    gone = persist_table(prior.select("CommentId").distinct().join(known, "CommentId", "left_anti"), "texts-gone")
    old = lookup_join(prior.select(*columns), gone, ["CommentId"], "left_semi")
    # Dimension and nonresponses are disjoint; only the earlier report repeats a text.
    return known.unionByName(old.dropDuplicates(["CommentId"]))


def attach_text(report: DataFrame, texts: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Add the comment's text to every report row; rows without a comment take no part in the join."""
    blank = F.when(F.col("CommentId").isNotNull(), F.lit(""))
    bare = report.filter(has_empty_id()).withColumn("SurveyComment", blank)
    spread = [c for c in ("FeedbackId", "SegmentNumber") if c in report.columns]
    named = skew_join(report.filter(~has_empty_id()), texts, ["CommentId"], "left", spread, hot)
    return named.unionByName(bare)


def attach_text_dealt(report: DataFrame, texts: DataFrame, buckets: int, hot: DataFrame | None = None) -> DataFrame:
    """``attach_text`` for a whole report, dealt out by response: a text travels once for each response, not for each of its segments.

    Rows of a response end up side by side, so in a table their text takes little more room than one. Rows without a response get
    their texts by the comment. ``texts`` has one row per comment.
    """
    named = F.col("FeedbackId").isNotNull()
    owners = attach_text(report.filter(named).select("FeedbackId", "CommentId").distinct(), texts, hot)
    held = owners.repartition(buckets, "FeedbackId").groupBy("FeedbackId").agg(
        F.collect_list(F.struct("CommentId", "SurveyComment")).alias("_texts")
    )
    own = F.filter("_texts", lambda t: t["CommentId"] == F.col("CommentId"))
    rows = report.filter(named).repartition(buckets, "FeedbackId").join(held, "FeedbackId")
    rows = rows.withColumn("SurveyComment", F.get(own, F.lit(0))["SurveyComment"]).drop("_texts")
    loose = attach_text(report.filter(~named), texts, hot).repartition(buckets, "FeedbackId")
    return rows.select(*report.columns, "SurveyComment").unionByName(loose.select(*report.columns, "SurveyComment"))


def not_yet_in(rows: DataFrame, settled: DataFrame) -> DataFrame:
    """Rows that ``settled`` does not hold; both are brought together by response, so settled rows in buckets stay where they are."""
    body = F.struct(*[c for c in rows.columns if c != "SurveyComment"])
    ids = rows.select("FeedbackId").distinct()
    there = settled.join(ids, "FeedbackId", "left_semi").groupBy("FeedbackId").agg(F.collect_set(body).alias("_there"))
    held = F.coalesce(F.array_contains("_there", body), F.lit(False))
    return rows.join(there, "FeedbackId", "left").filter(~held).drop("_there")


def assemble_report(
    total: DataFrame,
    inherited: DataFrame,
    nonresponses: DataFrame,
    empties: DataFrame,
    fact: DataFrame,
    context: DataFrame,
    texts: DataFrame | None,
    survey_type: str,
    hot: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """All report rows: removals honoured, context, one dedupe, text, types, product id.

    ``total`` is nearly all of the report. Removals, context and the dedupe work on rows by response, so in buckets of FeedbackId
    it is not exchanged for them, nor for its texts if it has them. The other rows are made ready by themselves, lose what
    ``total`` holds already, get their texts, and with ``buckets`` are dealt out as that many. Without ``texts`` the rows come
    without theirs, for what needs none.
    """
    columns = [c for c in REPORT.names if c != "UserContext"]

    def ready(rows: DataFrame) -> DataFrame:
        kept = enrich_context(drop_removed_feedback(predicted_product_id(rows), fact), context)
        # A text goes with its comment's id, so rows with texts may be compared as a whole.
        return kept.distinct()

    carried = texts is not None and "SurveyComment" in total.columns
    named = (lambda rows: rows) if texts is None else (lambda rows: attach_text(rows, texts, hot))
    settled = ready(typed_backfill(total, REPORT).select(*columns, *(["SurveyComment"] if carried else [])))
    fresh = ready(reduce(DataFrame.unionByName, [typed_backfill(p, REPORT).select(*columns) for p in (inherited, nonresponses, empties)]))
    fresh = persist_table(fresh, "report-fresh")
    fresh = named(not_yet_in(fresh, settled))
    if buckets:
        fresh = fresh.repartition(buckets, "FeedbackId")
    rows = (settled if carried else named(settled)).unionByName(fresh)
    return conform(rows.withColumn("SurveyType", F.lit(survey_type)), REPORT_ROWS if texts is None else REPORT_OUT)
