"""Every registered query: the library's operator on the stage frames, and the same in SQL."""

from __future__ import annotations

import re
from functools import reduce
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks import rules
from checks.frames import Frames
from checks.stages_sql import (
    BLANKS, LINE_BREAKS, NULL_FIELDS, ROW, WORKLOAD_NAMES, case_map, complete, counts, norm, quoted, row_of, score, snap_table, sql_list, words,
)
from checks.views import CUTOFF, DAY1, DAY2, SURVEY
from earshot import config
from earshot.functions import prompts
from earshot.functions.text import clean_segments, word_set
from earshot.operators import comments, completions, fuzzy, labels, quality, report, segments, shape, transformer
from earshot.schemas import (
    COMMENT_DIM, COMPLETIONS, LABEL_COLUMNS, LABEL_TYPES, VALIDATED_TYPES,
)
from earshot.session import scratch_path
from earshot.sources import paging, retention, tables

Query = Callable[[Frames], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Columns that show a report row, its text by its id.
SHOWN = [
    "DIM_DateId", "DIM_ProductMasterId", "FeedbackId", "CommentId", "Segment", "SegmentNumber",
    "Coverage", "CumulativeCoverage", *LABEL_COLUMNS, "Score", "ReportingType",
]
DOUBLES = {"Coverage", "CumulativeCoverage", "Cosine"}
DIM_SHOWN = [c for c in COMMENT_DIM.names if c != "SurveyComment"]
FACT_SHOWN = ["DIM_DateId", "DIM_ProductMasterId", "FeedbackId", "CommentId", "Score"]


def show(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in DOUBLES else F.col(c) for c in columns])


def shown(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in DOUBLES else c for c in columns)


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = complete(sql, extra)
        return fn

    return register


def store(f: Frames, label: str) -> tables.TableStore:
    return tables.TableStore(f.spark, scratch_path(f.spark, label))


# ---------------------------------------------------------------- sources and sinks


@query("scan_table", "SELECT FeedbackId, DIM_DateId, Score, length(SurveyComment) AS Size FROM fact_survey")
def _(f):
    kept = store(f, "scan").overwrite("fact_survey", f.view("fact_survey"))
    return kept.select("FeedbackId", "DIM_DateId", "Score", F.length("SurveyComment").alias("Size"))


@query(
    "overwrite_table",
    f"SELECT {', '.join(c for c in DIM_SHOWN if c != 'ReportingDate')},"
    f" CASE WHEN ReportingDate IS NULL AND ProcessingDate IS NOT NULL"
    f" AND CommentId IN (SELECT CommentId FROM prior_report) THEN {DAY2} ELSE ReportingDate END"
    " AS ReportingDate FROM known",
)
def _(f):
    kept = store(f, "overwrite")
    kept.overwrite("dim", f.known_state)
    return kept.overwrite("dim", comments.mark_reported(kept.read("dim"), f.prior_rows, DAY2)).select(*DIM_SHOWN)


@query(
    "overwrite_partition",
    f"SELECT FeedbackId, DIM_DateId, {DAY1} AS RunDateId FROM eligible_day1"
    f" UNION ALL SELECT FeedbackId, DIM_DateId, {DAY2} FROM processed",
)
def _(f):
    kept = store(f, "partition")
    shape_of = lambda df, day: df.select("FeedbackId", "DIM_DateId", F.lit(day).alias("RunDateId"))
    kept.overwrite_partition("runs", shape_of(f.eligible("day1"), DAY1), {"RunDateId": DAY1})
    kept.overwrite_partition("runs", shape_of(f.eligible("day2"), DAY2), {"RunDateId": DAY2})
    rows = shape_of(f.processed, DAY2)
    kept.overwrite_partition("runs", rows, {"RunDateId": DAY2})
    return kept.read("runs", rows.schema)


@query(
    "read_or_empty",
    f"SELECT {', '.join(c for c in DIM_SHOWN if not c.endswith('gDate') and c != 'TokenCount' and c != 'CharacterCount')},"
    " NULL::BIGINT AS TokenCount, NULL::INT AS ProcessingDate, NULL::INT AS ReportingDate,"
    " length(SurveyComment) AS CharacterCount FROM answers_day1",
)
def _(f):
    known = store(f, "first").read_or_empty("comment_dim", COMMENT_DIM)
    return comments.upsert_comment_dim(f.stats_state("day1"), known).select(*DIM_SHOWN)


@query("scan_side_files", "SELECT c_custkey, c_mktsegment FROM customer")
def _(f):
    return tables.scan_side_files(f.spark, f"{f.sf_dir}/customer.parquet", ["c_custkey", "c_mktsegment"])


def long_labels(f: Frames) -> DataFrame:
    return f.labelled_raw.unpivot(
        [*labels.SEGMENT_KEY, *labels.SEGMENT_BODY], LABEL_COLUMNS, "LabelType", "Label"
    ).withColumn("LabelType", F.regexp_replace("LabelType", "Label$", ""))


LONG_LABELS = " UNION ALL ".join(
    "SELECT CommentId, SegmentNumber, Segment, Coverage, CumulativeCoverage, RunDateId,"
    f" '{t}' AS LabelType, {t}Label AS Label FROM labelled_raw"
    for t in LABEL_TYPES
)


@query(
    "label_store_roundtrip",
    "SELECT CommentId, SegmentNumber, LabelType, RunDateId, Label FROM long_labels"
    " WHERE LabelType IN ('Workload', 'Platform')",
    {"long_labels": LONG_LABELS},
)
def _(f):
    kept = store(f, "labels")
    rows = long_labels(f).select("CommentId", "SegmentNumber", "Label", "RunDateId", "LabelType")
    kept.overwrite_partitions("labels", rows, ["RunDateId", "LabelType"])
    read = lambda t: kept.read_partition("labels", rows.schema, {"RunDateId": DAY2, "LabelType": t})
    return read("Workload").unionByName(read("Platform"))


@query(
    "temp_views",
    "SELECT f.FeedbackId, f.DIM_DateId AS Now, p.DIM_DateId AS Before, p.SegmentNumber"
    " FROM reportable_day2 f JOIN prior_report p ON f.FeedbackId = p.FeedbackId",
)
def _(f):
    tables.register_views({"fact_now": f.reportable("day2"), "report_before": f.prior_report})
    return f.spark.sql(
        "SELECT f.FeedbackId, f.DIM_DateId AS Now, p.DIM_DateId AS Before, p.SegmentNumber"
        " FROM fact_now f JOIN report_before p ON f.FeedbackId = p.FeedbackId"
    )


def numbered_sql(source: str, columns: list[str], size: int, name: str) -> str:
    listed = ", ".join(columns)
    text = ", ".join(f"coalesce({c}::VARCHAR, '')" for c in columns)
    order = f"substr(md5(concat_ws('|', {text})), 1, 3), {listed}"
    return (
        f"SELECT *, (RowNumber - 1) // {size} AS {name} FROM"
        f" (SELECT {listed}, row_number() OVER (ORDER BY {order}) AS RowNumber FROM {source})"
    )


@query("paged_source", numbered_sql("event_keys", ["FeedbackId", "SurveyType"], 1000, "Page"))
def _(f):
    return paging.with_pages(f.view("event_keys"))


@query("paged_read", numbered_sql("event_keys", ["FeedbackId", "SurveyType"], 30000, "Page"))
def _(f):
    paged = paging.store_pages(f.view("event_keys"), 30000)
    return reduce(DataFrame.unionByName, paging.each_page(paged, 30000))


@query("batch_ids", numbered_sql("prior_report", ["FeedbackId", "SegmentNumber"], 500, "Batch"))
def _(f):
    return paging.with_pages(f.prior_rows.select("FeedbackId", "SegmentNumber"), 500, "Batch")


SEARCH_KEY = ["FeedbackId", "SegmentNumber", "SurveyType"]


@query("batched_sink", "SELECT FeedbackId, SegmentNumber, SurveyType, ReportingDate FROM search_after")
def _(f):
    before = f.view("search_before")
    changes = paging.change_set(before, f.view("search_after"), SEARCH_KEY)
    return paging.apply_changes(before, changes, SEARCH_KEY)


@query(
    "batched_sink_counts",
    """SELECT Action, count(*) AS Requested, count_if(works)::BIGINT AS Affected FROM (
         SELECT CASE WHEN b.FeedbackId IS NULL THEN 'insert' WHEN a.FeedbackId IS NULL THEN 'delete' ELSE 'update' END AS Action,
                CASE WHEN b.FeedbackId IS NULL THEN o.SegmentNumber IS NULL ELSE o.SegmentNumber IS NOT NULL END AS works
         FROM search_before b FULL JOIN search_after a USING (FeedbackId, SegmentNumber, SurveyType)
         LEFT JOIN (SELECT * FROM search_before WHERE ReportingDate < 20231120 AND SurveyType = 'NPS') o
              USING (FeedbackId, SegmentNumber, SurveyType)
         WHERE b.FeedbackId IS NULL OR a.FeedbackId IS NULL OR a.ReportingDate <> b.ReportingDate)
       GROUP BY Action""",
)
def _(f):
    before = f.view("search_before")
    changes = paging.change_set(before, f.view("search_after"), SEARCH_KEY)
    return paging.affected_rows(before.filter("SurveyType = 'NPS'"), changes, SEARCH_KEY)


@query(
    "batch_hand_over",
    """SELECT Action, count(*) AS Rows, count_if(SegmentNumber % 2 = 0)::BIGINT AS Affected FROM (
         SELECT CASE WHEN b.FeedbackId IS NULL THEN 'insert' WHEN a.FeedbackId IS NULL THEN 'delete' ELSE 'update' END AS Action, SegmentNumber
         FROM (SELECT FeedbackId, SegmentNumber, SurveyType, ReportingDate FROM search_before) b
         FULL JOIN search_after a USING (FeedbackId, SegmentNumber, SurveyType)
         WHERE b.FeedbackId IS NULL OR a.FeedbackId IS NULL OR a.ReportingDate <> b.ReportingDate)
       GROUP BY Action""",
)
def _(f):
    def accepts_even(rows: list[dict]) -> int:
        """A keyed store that finds something to change in every row with an even segment number."""
        return sum(1 for r in rows if r["SegmentNumber"] % 2 == 0)

    changes = paging.change_set(f.view("search_before"), f.view("search_after"), SEARCH_KEY)
    sent = [
        paging.send_batches(changes.filter(F.col("Action") == a), accepts_even, 500).select(F.lit(a).alias("Action"), "Rows", "Affected")
        for a in ("insert", "update", "delete")
    ]
    return reduce(DataFrame.unionByName, sent)


@query(
    "expired_tables",
    r"""SELECT name, TableDate::VARCHAR AS TableDate FROM (
          SELECT name, try_strptime(nullif(regexp_extract(name, '(?:^|_)([0-9]{8})(?:_|$)', 1), ''), '%Y%m%d')::DATE AS TableDate
          FROM listing WHERE contains(name, '_buffer_'))
        WHERE TableDate <= DATE '2023-11-20' - 3""",
)
def _(f):
    expired = retention.expired_tables(f.view("listing"), 20231120, 3)
    return expired.select("name", F.col("TableDate").cast("string").alias("TableDate"))


# ---------------------------------------------------------------- filters and typing

_B1 = (
    f"SurveyType = '{SURVEY}' AND InternalResponseFlag = 'False' AND DIM_DateId >= {CUTOFF}"
)


@query(
    "eligible_responses",
    f"SELECT FeedbackId, SurveyComment, DIM_DateId, DIM_ProductMasterId FROM fact_survey WHERE {_B1}"
    " AND SurveyComment IS NOT NULL AND SurveyComment <> ''",
)
def _(f):
    rows = shape.eligible_responses(f.view("fact_survey"), SURVEY, CUTOFF)
    return rows.select("FeedbackId", "SurveyComment", "DIM_DateId", "DIM_ProductMasterId")


@query(
    "eligible_for_report",
    f"SELECT FeedbackId, SurveyComment, DIM_DateId, DIM_ProductMasterId, Score FROM fact_survey WHERE {_B1}",
)
def _(f):
    rows = shape.eligible_for_report(f.view("fact_survey"), SURVEY, CUTOFF)
    return rows.select("FeedbackId", "SurveyComment", "DIM_DateId", "DIM_ProductMasterId", "Score")


@query(
    "product_allowlist",
    "SELECT FeedbackId, DIM_ProductMasterId FROM fact_survey WHERE DIM_ProductMasterId BETWEEN 10 AND 16",
)
def _(f):
    return shape.product_allowlist(f.view("fact_survey"), config.product_ids()).select(
        "FeedbackId", "DIM_ProductMasterId"
    )


@query(
    "product_allowlist_table",
    "SELECT FeedbackId, DIM_ProductMasterId FROM fact_survey"
    " WHERE DIM_ProductMasterId IN (SELECT p_size FROM part)",
)
def _(f):
    rows = shape.product_allowlist(f.view("fact_survey"), f.table("part").select("p_size"))
    return rows.select("FeedbackId", "DIM_ProductMasterId")


@query(
    "empty_responses",
    f"SELECT FeedbackId, DIM_DateId, Score, {NULL_FIELDS}, ReportingType FROM (SELECT FeedbackId, DIM_DateId, Score, ReportingType FROM empty_day2)",
)
def _(f):
    rows = shape.empty_responses(
        shape.product_allowlist(
            shape.eligible_for_report(f.view("day2"), SURVEY, CUTOFF), config.product_ids()
        )
    )
    return rows.select(
        "FeedbackId", "DIM_DateId", "Score", "Segment", "SegmentNumber", "Coverage",
        "CumulativeCoverage", *LABEL_COLUMNS, "ReportingType",
    )


@query("nonresponse_split", "SELECT CommentId, ResponseCount, IsNonresponse FROM flagged_day2")
def _(f):
    split = comments.nonresponse_split(comments.comment_stats(f.eligible("day2")), f.dictionary)
    return split.select("CommentId", "ResponseCount", "IsNonresponse")


@query(
    "date_ids",
    """SELECT doc_id, DateText, strftime(day, '%Y%m%d') AS DateString,
              CAST(strftime(day, '%Y%m%d') AS INT) AS DateInt, day IS NULL AS Rejected
       FROM (SELECT doc_id, DateText,
                    CASE WHEN coalesce(DateText, '') = '' THEN DATE '2023-11-29'
                         WHEN regexp_full_match(DateText, '[0-9]{8}') THEN try_strptime(DateText, '%Y%m%d')::DATE
                         WHEN regexp_full_match(DateText, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN try_strptime(DateText, '%Y-%m-%d')::DATE
                    END AS day FROM date_texts)""",
)
def _(f):
    return shape.date_ids(f.view("date_texts"), "DateText", DAY2)


@query(
    "typed_backfill",
    "SELECT CommentId, ResponseCount, NULL::BIGINT AS TokenCount, NULL::INT AS ProcessingDate,"
    f" {DAY2}::INT AS ReportingDate FROM answers_day2",
)
def _(f):
    rows = shape.typed_backfill(f.stats_state("day2"), COMMENT_DIM, {"ReportingDate": DAY2})
    return rows.select("CommentId", "ResponseCount", "TokenCount", "ProcessingDate", "ReportingDate")


@query(
    "conform_schema",
    "SELECT NULL::INT AS DIM_DateId, try_cast(DateText AS INT) AS Score, doc_id::VARCHAR AS FeedbackId FROM date_texts",
)
def _(f):
    from pyspark.sql import types as T

    loose = f.view("date_texts").select(
        F.col("doc_id").alias("FeedbackId"),
        F.col("DateText").alias("Score"),
        F.lit("none").alias("DIM_DateId"),
    )
    wanted = T.StructType().add("DIM_DateId", "integer").add("Score", "integer").add("FeedbackId", "string")
    return shape.conform(loose, wanted)


@query(
    "rename_labels",
    f"SELECT CommentId, SegmentNumber, {case_map('PlatformLabel', {'Speed': 'Performance', 'Cost': 'Price'})} AS PlatformLabel,"
    f" {case_map('WorkloadLabel', WORKLOAD_NAMES)} AS WorkloadLabel FROM snapped",
)
def _(f):
    rows = labels.snap_to_vocabulary(f.labelled_raw)
    named = labels.rename_workloads(rows)
    short = f.spark.createDataFrame([("Speed", "Performance"), ("Cost", "Price")], "label string, name string")
    return shape.rename_labels(named, "PlatformLabel", short).select(
        "CommentId", "SegmentNumber", "PlatformLabel", "WorkloadLabel"
    )


@query(
    "workload_name_rules",
    f"SELECT CommentId, SegmentNumber, {case_map('WorkloadLabel', WORKLOAD_NAMES)} AS WorkloadLabel FROM snapped",
)
def _(f):
    rows = shape.workload_names(labels.snap_to_vocabulary(f.labelled_raw, ["Workload"]))
    return rows.select("CommentId", "SegmentNumber", "WorkloadLabel")


@query(
    "predicted_product_id",
    "SELECT CommentId, SegmentNumber, WorkloadLabel AS WorkloadLabel_original,"
    f" {case_map('WorkloadLabel', config.WORKLOAD_DISPLAY)} AS WorkloadLabel,"
    f" CAST({case_map(case_map('WorkloadLabel', config.WORKLOAD_DISPLAY), config.WORKLOAD_PRODUCT)} AS INT)"
    " AS Predicted_DIM_ProductMasterId FROM labelled",
)
def _(f):
    return shape.predicted_product_id(f.labelled).select(
        "CommentId", "SegmentNumber", "WorkloadLabel_original", "WorkloadLabel",
        "Predicted_DIM_ProductMasterId",
    )


@query("context_normalise", "SELECT FeedbackId, coalesce(Value, '') AS UserContext FROM context")
def _(f):
    return f.context


@query(
    "triage_completions",
    "SELECT CommentId, Status FROM completed UNION ALL"
    " SELECT CommentId || '-' || SegmentNumber, CASE WHEN length(Segment) % 97 = 0 THEN 'error' ELSE 'ok' END FROM segments"
    " UNION ALL SELECT 'good ' || CommentId, SegmentNumber::VARCHAR FROM segments"
    " WHERE CommentId NOT IN (SELECT CommentId FROM segments WHERE length(Segment) % 97 = 0)",
)
def _(f):
    answers = f.label_answers("Sentiment")
    good = completions.good_rows(answers)
    return (
        f.completed.select("CommentId", "Status")
        .unionByName(
            answers.select(
                F.concat_ws("-", "CommentId", F.col("SegmentNumber").cast("string")).alias("CommentId"),
                "Status",
            )
        )
        .unionByName(
            good.select(
                F.concat(F.lit("good "), "CommentId").alias("CommentId"),
                F.col("SegmentNumber").cast("string").alias("Status"),
            )
        )
    )


@query(
    "quarantine_rows",
    f"SELECT CommentId, Status, {DAY2} AS RunDateId FROM completed WHERE Status <> 'ok'",
)
def _(f):
    return completions.quarantine_rows(f.completed, DAY2).select("CommentId", "Status", "RunDateId")


# ---------------------------------------------------------------- comment lifecycle


@query(
    "drop_removed_comments",
    f"SELECT {', '.join(DIM_SHOWN)} FROM known WHERE CommentId IN (SELECT CommentId FROM eligible_day2)",
)
def _(f):
    return comments.drop_removed_comments(f.known_state, f.eligible("day2")).select(*DIM_SHOWN)


@query(
    "drop_removed_feedback",
    f"SELECT {shown(SHOWN)} FROM prior_report WHERE FeedbackId IN (SELECT FeedbackId FROM reportable_day2)",
)
def _(f):
    return show(report.drop_removed_feedback(f.prior_rows, f.reportable("day2")), SHOWN)


@query(
    "repeat_responses",
    """SELECT s.SurveyType, s.CommentId, s.FirstResponseDate, s.LastResponseDate, k.TokenCount,
              k.ProcessingDate, k.ReportingDate, length(s.SurveyComment) AS CharacterCount, s.ResponseCount
       FROM stats_day2 s JOIN known k USING (SurveyType, CommentId)""",
)
def _(f):
    return comments.repeat_responses(f.eligible("day2"), f.known_state).select(*DIM_SHOWN)


@query(
    "new_responses",
    "SELECT FeedbackId, CommentId, DIM_DateId FROM eligible_day2"
    " WHERE CommentId NOT IN (SELECT CommentId FROM known)",
)
def _(f):
    rows = comments.new_responses(f.eligible("day2"), f.known_state, f.hot("day2"))
    return rows.select("FeedbackId", "CommentId", "DIM_DateId")


@query("upsert_comment_dim", f"SELECT {', '.join(DIM_SHOWN)} FROM dim")
def _(f):
    return comments.upsert_comment_dim(f.stats_state("day2"), f.known_state).select(*DIM_SHOWN)


@query(
    "join_on",
    "SELECT s.CommentId, SegmentNumber, length(SurveyComment) AS Size FROM segments s JOIN dim USING (CommentId)",
)
def _(f):
    rows = labels.join_on(f.segments, f.dim.select("CommentId", "SurveyComment"), "CommentId")
    return rows.select("CommentId", "SegmentNumber", F.length("SurveyComment").alias("Size"))


@query(
    "multi_join",
    f"SELECT CommentId, SegmentNumber, Segment, round(Coverage, 6) AS Coverage, {', '.join(LABEL_COLUMNS)} FROM labelled_raw"
    " WHERE length(Segment) % 97 <> 0",
)
def _(f):
    bad = (F.col("LabelType") == "Support") & (F.length("Segment") % 97 == 0)
    wide = labels.labels_wide(long_labels(f).filter(~bad), LABEL_TYPES)
    return show(wide, ["CommentId", "SegmentNumber", "Segment", "Coverage", *LABEL_COLUMNS])


@query(
    "multi_join_frames",
    f"SELECT CommentId, SegmentNumber, {', '.join(LABEL_COLUMNS)} FROM labelled_raw",
)
def _(f):
    parts = [f.labelled_raw.select(*labels.SEGMENT_KEY, c) for c in LABEL_COLUMNS]
    return labels.multi_join(parts, labels.SEGMENT_KEY)


_CACHED = "(SELECT CommentId FROM known)"


@query(
    "segment_cache_hits",
    f"SELECT CommentId, SegmentNumber, Segment FROM segments WHERE CommentId IN {_CACHED}"
    " AND CommentId IN (SELECT CommentId FROM dim)",
)
def _(f):
    return segments.segment_cache_hits(cache(f), f.dim_state).select("CommentId", "SegmentNumber", "Segment")


def cache(f: Frames) -> DataFrame:
    """Segments of the comments known on day 1."""
    return f.segments.join(f.known_state.select("CommentId"), "CommentId", "left_semi")


@query(
    "segment_cache_misses",
    "SELECT CommentId, ResponseCount FROM dim WHERE CommentId NOT IN"
    f" (SELECT CommentId FROM segments WHERE CommentId IN {_CACHED})",
)
def _(f):
    return segments.segment_cache_misses(cache(f), f.dim_state).select("CommentId", "ResponseCount")


@query("extend_segment_cache", f"SELECT {shown(['CommentId', 'SegmentNumber', 'Coverage'])} FROM segments")
def _(f):
    grown = segments.extend_segment_cache(cache(f), f.segments)
    return show(grown, ["CommentId", "SegmentNumber", "Coverage"])


@query("unprocessed_work", "SELECT CommentId, SegmentNumber, WorkloadLabel FROM today")
def _(f):
    return comments.unprocessed_work(f.labelled, f.dim_state).select(
        "CommentId", "SegmentNumber", "WorkloadLabel"
    )


# ---------------------------------------------------------------- report


@query("processed_fact", f"SELECT {', '.join(FACT_SHOWN)} FROM processed")
def _(f):
    return report.processed_fact(f.reportable("day2"), f.dim_done, f.hot("day2")).select(*FACT_SHOWN)


@query("nonresponse_fact", f"SELECT {shown(SHOWN)} FROM silent_day2")
def _(f):
    rows = report.nonresponse_fact(f.reportable("day2"), f.nonresponse_ids("day2"), f.hot("day2"))
    return show(rows, SHOWN)


@query("current_report", f"SELECT {shown(SHOWN)} FROM current")
def _(f):
    return show(report.current_report(f.processed, f.today, f.hot("day2")), SHOWN)


@query("restate_bucketed_report", f"SELECT {shown(SHOWN)} FROM restated")
def _(f):
    kept = store(f, "bucketed").overwrite_bucketed("report", f.prior_dealt(8), "FeedbackId", 8)
    return show(report.restate_prior_report(f.reportable("day2"), kept), SHOWN)


@query("restate_prior_report", f"SELECT {shown(SHOWN)} FROM restated")
def _(f):
    return show(f.restated, SHOWN)


@query("supersede_prior", f"SELECT {shown(SHOWN)} FROM total")
def _(f):
    return show(report.supersede_prior(f.current, f.restated), SHOWN)


@query("unreported_repeats", f"SELECT {', '.join(FACT_SHOWN)} FROM repeats")
def _(f):
    return f.repeats.select(*FACT_SHOWN)


@query("inherit_labels", f"SELECT {shown(SHOWN)} FROM inherited")
def _(f):
    return show(report.inherit_labels(f.repeats, f.total, hot=f.hot("day2")), SHOWN)


@query(
    "inherit_labels_single",
    """SELECT r.FeedbackId, r.CommentId, t.SegmentNumber, t.Segment, t.WorkloadLabel
       FROM repeats r JOIN (
            SELECT *, row_number() OVER (PARTITION BY CommentId ORDER BY DIM_DateId DESC, FeedbackId, SegmentNumber) AS place
            FROM total) t USING (CommentId) WHERE place = 1""",
)
def _(f):
    rows = report.inherit_labels(f.repeats, f.total, mode="single", hot=f.hot("day2"))
    return rows.select("FeedbackId", "CommentId", "SegmentNumber", "Segment", "WorkloadLabel")


@query(
    "latest_per_comment",
    f"""SELECT {shown(SHOWN)} FROM (
            SELECT *, row_number() OVER (PARTITION BY CommentId ORDER BY DIM_DateId DESC, FeedbackId, SegmentNumber NULLS FIRST) AS place
            FROM final_report) WHERE place = 1""",
)
def _(f):
    return show(report.latest_per_comment(f.final_rows), SHOWN)


@query(
    "enrich_context",
    "SELECT t.FeedbackId, SegmentNumber, c.UserContext FROM total t LEFT JOIN one_context c USING (FeedbackId)",
)
def _(f):
    return report.enrich_context(f.total, f.context).select("FeedbackId", "SegmentNumber", "UserContext")


@query(
    "write_back_dates",
    f"""SELECT CommentId, ProcessingDate,
               CASE WHEN ReportingDate IS NULL AND ProcessingDate IS NOT NULL
                     AND CommentId IN (SELECT CommentId FROM current) THEN {DAY2} ELSE ReportingDate END AS ReportingDate
        FROM dim_done""",
)
def _(f):
    done = comments.mark_processed(f.dim_state, f.today, DAY2)
    return comments.mark_reported(done, f.current, DAY2).select("CommentId", "ProcessingDate", "ReportingDate")


# Letter counts stand in for embeddings: a text-derived vector both engines can build.
LOOSE = 250
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 .,"


def letter_vector(text: Column) -> Column:
    low = F.lower(text)
    return F.array(
        *[(F.length(low) - F.length(F.replace(low, F.lit(c), F.lit("")))).cast("double") for c in LETTERS]
    )


# The other engine's edit distance counts bytes; each accented letter of the given texts is
# swapped for a one-byte control character first, which makes it count characters.
ACCENTED = "éóèñüçäöêßíÉÈÑÓÇÊÜÖÄÍ"


def one_byte(text: str) -> str:
    codes = "||".join(f"chr({c})" for c in [*range(1, 9), *range(14, 27)])
    return f"translate({text}, '{ACCENTED}', {codes})"


LETTER_VECTOR = (
    "list_transform(string_split(" + quoted("|".join(LETTERS)) + ", '|'),"
    " lambda c: (length(lower(SurveyComment)) - length(replace(lower(SurveyComment), c, '')))::DOUBLE)"
)
FUZZY = {
    "arrived": f"SELECT CommentId, SurveyComment, {LETTER_VECTOR} AS v FROM dim WHERE CommentId NOT IN (SELECT CommentId FROM known)",
    "settled": f"SELECT CommentId, SurveyComment, {LETTER_VECTOR} AS v FROM dim WHERE ReportingDate IS NOT NULL",
    "nearest": """
        SELECT CommentId, KnownCommentId, Cosine, Place, mine, theirs FROM (
            SELECT *, row_number() OVER (PARTITION BY CommentId ORDER BY Cosine DESC, KnownCommentId) AS Place
            FROM (SELECT a.CommentId, s.CommentId AS KnownCommentId, a.SurveyComment AS mine, s.SurveyComment AS theirs,
                         round(list_cosine_similarity(a.v, s.v), 9) AS Cosine
                  FROM arrived a, settled s)
            WHERE Cosine >= 0.95) WHERE Place <= 5""",
    **{
        name: f"""
        SELECT CommentId, KnownCommentId, mine AS SurveyComment, theirs AS SurveyCommentDeduped FROM (
            SELECT *, row_number() OVER (PARTITION BY CommentId ORDER BY Place) AS first
            FROM nearest WHERE abs(length(mine) - length(theirs)) <= {limit} AND levenshtein({one_byte("mine")}, {one_byte("theirs")}) <= {limit})
        WHERE first = 1"""
        for name, limit in (("duplicate_map", 15), ("loose_map", LOOSE))
    },
    "segments_of_known": f"SELECT DISTINCT CommentId AS KnownCommentId, Segment, SegmentNumber, Coverage, CumulativeCoverage, {', '.join(LABEL_COLUMNS)}, ReportingType FROM total",
}


def arrived(f: Frames) -> DataFrame:
    rows = f.with_texts(f.dim_state.join(f.known_state.select("CommentId"), "CommentId", "left_anti"))
    return rows.select("CommentId", "SurveyComment", letter_vector(F.col("SurveyComment")).alias("Vector"))


def settled(f: Frames) -> DataFrame:
    return f.with_texts(f.dim_state.filter("ReportingDate IS NOT NULL")).select(
        "CommentId", "SurveyComment", letter_vector(F.col("SurveyComment")).alias("Vector")
    )


def loose_map(f: Frames) -> DataFrame:
    """Pairs within a wider edit limit, of which the given texts have many more."""
    return f.stored(
        "loose_map", lambda: fuzzy.fuzzy_duplicate_map(arrived(f), settled(f), max_edits=LOOSE)
    )


@query(
    "fuzzy_duplicate_map",
    "SELECT CommentId, KnownCommentId, SurveyComment, SurveyCommentDeduped FROM duplicate_map",
    FUZZY,
)
def _(f):
    return fuzzy.fuzzy_duplicate_map(arrived(f), settled(f)).drop("ReportingDate")


# Near copies of every reported comment: letters lost in front, two replaced, a mark added.
EDITED = "concat(substr(SurveyComment, 4, 60), 'zz', substr(SurveyComment, 66), '!!')"


@query(
    "fuzzy_duplicate_map_edited",
    "SELECT CommentId, KnownCommentId, SurveyComment, SurveyCommentDeduped FROM duplicate_map",
    FUZZY
    | {
        "edited": f"SELECT concat('near-', CommentId) AS CommentId, {EDITED} AS SurveyComment FROM dim WHERE ReportingDate IS NOT NULL",
        "arrived": f"SELECT CommentId, SurveyComment, {LETTER_VECTOR} AS v FROM edited",
    },
)
def _(f):
    rows = settled(f).select(F.concat(F.lit("near-"), "CommentId").alias("CommentId"), F.expr(EDITED).alias("SurveyComment"))
    near = rows.withColumn("Vector", letter_vector(F.col("SurveyComment")))
    return fuzzy.fuzzy_duplicate_map(near, settled(f)).drop("ReportingDate")


@query("fuzzy_duplicate_map_loose", "SELECT CommentId, KnownCommentId FROM loose_map", FUZZY)
def _(f):
    return loose_map(f).select("CommentId", "KnownCommentId")


@query(
    "fuzzy_nearest",
    "SELECT CommentId, KnownCommentId, round(Cosine, 6) AS Cosine, Place FROM nearest",
    FUZZY,
)
def _(f):
    near = fuzzy.nearest_known(arrived(f), settled(f))
    return show(near, ["CommentId", "KnownCommentId", "Cosine", "Place"])


@query(
    "fuzzy_nearest_embeddings",
    """SELECT CommentId, KnownCommentId, round(Cosine, 6) AS Cosine, Place FROM (
         SELECT *, row_number() OVER (PARTITION BY CommentId ORDER BY Cosine DESC, KnownCommentId) AS Place FROM (
           SELECT a.vec_id::VARCHAR AS CommentId, b.vec_id::VARCHAR AS KnownCommentId,
                  round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS Cosine
           FROM embeddings a, embeddings b)
         WHERE Cosine >= 0.4) WHERE Place <= 5""",
)
def _(f):
    rows = f.table("embeddings").select(
        F.col("vec_id").cast("string").alias("CommentId"), F.col("embedding").alias("Vector")
    )
    return show(
        fuzzy.nearest_known(rows, rows, min_cosine=0.4, cells=32),
        ["CommentId", "KnownCommentId", "Cosine", "Place"],
    )


@query(
    "maintain_duplicate_map",
    f"""SELECT d.CommentId, d.KnownCommentId,
               CASE WHEN d.CommentId IN (SELECT CommentId FROM reportable_day2)
                     AND d.KnownCommentId IN (SELECT CommentId FROM total) THEN {DAY2} END AS ReportingDate
        FROM loose_map d WHERE CommentId NOT IN (SELECT CommentId FROM known WHERE ReportingDate IS NOT NULL)
        UNION ALL SELECT CommentId, CommentId, {DAY1} FROM known WHERE ReportingDate IS NOT NULL""",
    FUZZY,
)
def _(f):
    old = f.known.filter("ReportingDate IS NOT NULL").select(
        "CommentId", F.col("CommentId").alias("KnownCommentId"), "SurveyComment",
        F.col("SurveyComment").alias("SurveyCommentDeduped"), "ReportingDate",
    )
    grown = fuzzy.maintain_duplicate_map(old, loose_map(f))
    added = report.fan_out_duplicates(grown, f.total, f.reportable("day2"), f.hot("day2"))
    return fuzzy.stamp_reported_pairs(grown, added, DAY2).select(
        "CommentId", "KnownCommentId", "ReportingDate"
    )


@query(
    "fan_out_duplicates",
    f"""SELECT f.DIM_DateId, f.DIM_ProductMasterId, f.FeedbackId, f.CommentId, s.Segment, s.SegmentNumber,
               round(s.Coverage, 6) AS Coverage, round(s.CumulativeCoverage, 6) AS CumulativeCoverage,
               {', '.join('s.' + c for c in LABEL_COLUMNS)}, f.Score, s.ReportingType
        FROM loose_map d JOIN segments_of_known s USING (KnownCommentId)
        JOIN reportable_day2 f ON f.CommentId = d.CommentId""",
    FUZZY,
)
def _(f):
    rows = report.fan_out_duplicates(loose_map(f), f.total, f.reportable("day2"), f.hot("day2"))
    return show(rows, SHOWN)


_FINAL = [*SHOWN, "WorkloadLabel_original", "Predicted_DIM_ProductMasterId", "UserContext", "SurveyType", "SurveyComment"]


@query(
    "assemble_report",
    f"""SELECT {shown(_FINAL[:-1])}, SurveyComment FROM final_report LEFT JOIN (
            SELECT DISTINCT sha256(SurveyComment) AS CommentId, SurveyComment FROM fact_survey
            WHERE SurveyComment IS NOT NULL) USING (CommentId)""",
)
def _(f):
    fact = f.reportable("day2")
    rows = report.assemble_report(
        f.total, report.inherit_labels(f.repeats, f.total, hot=f.hot("day2")),
        report.nonresponse_fact(fact, f.nonresponse_ids("day2"), f.hot("day2")),
        shape.empty_responses(fact), fact, f.context, f.texts, SURVEY, f.hot("day2"),
    )
    return show(rows, _FINAL)


# ---------------------------------------------------------------- aggregates and checks


@query(
    "comment_stats",
    "SELECT CommentId, SurveyComment, FirstResponseDate, LastResponseDate, ResponseCount FROM stats_day2",
)
def _(f):
    return comments.comment_stats(f.eligible("day2")).drop("SurveyType")


@query("character_count", "SELECT CommentId, length(SurveyComment) AS CharacterCount FROM stats_day2")
def _(f):
    rows = comments.with_character_count(comments.comment_stats(f.eligible("day2")))
    return rows.select("CommentId", "CharacterCount")


@query("label_counts", "SELECT * FROM qc_now")
def _(f):
    reported = f.final_rows.filter(F.col("ReportingType") == "Report")
    return quality.label_counts(reported, DAY2)


@query(
    "label_counts_all_rows",
    " UNION ALL ".join(
        f"SELECT {DAY2} AS DIM_DateId, '{c}' AS LabelType, coalesce({c}, 'Not Labeled') AS LabelValue,"
        f" count(DISTINCT FeedbackId) AS DistinctResponseCount FROM final_report GROUP BY 3"
        for c in LABEL_COLUMNS
    ),
)
def _(f):
    return quality.label_counts(f.final_rows, DAY2)


@query(
    "label_counts_merged",
    " UNION ALL ".join(
        f"SELECT {DAY2} AS DIM_DateId, '{c}' AS LabelType, coalesce({c}, 'Not Labeled') AS LabelValue,"
        f" count(DISTINCT FeedbackId) AS DistinctResponseCount FROM final_report GROUP BY 3"
        for c in LABEL_COLUMNS
    ),
)
def _(f):
    """Days of the report one after the other, each numbered and added to what is stored."""
    rows = f.final_rows.select("FeedbackId", "DIM_DateId", *LABEL_COLUMNS)
    kept = store(f, "bitmaps")
    numbers = f.spark.createDataFrame([], "FeedbackId string, Number long")
    for early in (True, False):
        part = rows.filter(F.coalesce(F.col("DIM_DateId") <= DAY1, F.lit(True)) == F.lit(early))
        numbers = kept.overwrite("numbers", quality.number_responses(part, numbers))
        kept.add("labels", quality.label_bitmaps(part, numbers))
    schema = quality.label_bitmaps(rows, numbers).schema
    return quality.merged_label_counts(kept.parts("labels", schema), DAY2)


# The run's own rows as a snapshot: smaller than the day before, so many labels are flagged.
DRIFT = {
    "qc_run": counts("current", DAY2),
    "drift": f"""
        SELECT {DAY2} AS DIM_DateId, LabelType, LabelValue, coalesce(n.c, 0) AS DistinctResponseCount,
               CASE WHEN LabelValue = 'Not Labeled' THEN coalesce(n.c, 0) > coalesce(o.c, 0)
                    ELSE coalesce(n.c, 0) < coalesce(o.c, 0) END AS IssueFlag
        FROM (SELECT LabelType, LabelValue, DistinctResponseCount AS c FROM qc_before) o
        FULL JOIN (SELECT LabelType, LabelValue, DistinctResponseCount AS c FROM qc_run) n USING (LabelType, LabelValue)""",
    "qc": f"""
        SELECT DIM_DateId, LabelType, LabelValue, DistinctResponseCount, FALSE AS IssueFlag, '{SURVEY}' AS SurveyType FROM qc_before
        UNION ALL SELECT DIM_DateId, LabelType, LabelValue, DistinctResponseCount, IssueFlag, '{SURVEY}' FROM drift""",
}


def drift(f: Frames) -> DataFrame:
    return quality.label_drift(f.qc_before, quality.label_counts(f.current, DAY2), DAY2)


def qc(f: Frames) -> DataFrame:
    first = f.qc_before.withColumns({"IssueFlag": F.lit(False), "SurveyType": F.lit(SURVEY)})
    return quality.append_qc(first, drift(f), SURVEY)


@query("label_drift", "SELECT * FROM drift", DRIFT)
def _(f):
    return drift(f)


@query(
    "backfill_probe",
    f"SELECT min(ProcessingDate) AS OldestProcessingDate, min(ProcessingDate) = {DAY1} AS IsBackfill FROM known",
)
def _(f):
    return quality.backfill_probe(f.known_state, DAY1)


@query(
    "silence_backfill",
    f"SELECT LabelType, LabelValue, IssueFlag AND NOT (SELECT min(ProcessingDate) = {DAY1} FROM known) AS IssueFlag FROM drift",
    DRIFT,
)
def _(f):
    return quality.silence_backfill(drift(f), f.known_state, DAY1).select("LabelType", "LabelValue", "IssueFlag")


@query("latest_snapshot", f"SELECT * FROM qc WHERE DIM_DateId = {DAY2}", DRIFT)
def _(f):
    return quality.latest_snapshot(qc(f))


@query("append_qc", "SELECT * FROM qc", DRIFT)
def _(f):
    return qc(f)


@query(
    "drift_alerts",
    f"""SELECT * FROM qc WHERE IssueFlag AND DIM_DateId = {DAY2}
        UNION ALL SELECT * FROM qc WHERE DIM_DateId = {DAY1} AND (LabelType, LabelValue) IN
            (SELECT (LabelType, LabelValue) FROM drift WHERE IssueFlag)""",
    DRIFT,
)
def _(f):
    return quality.drift_alerts(qc(f), DAY2)


@query(
    "find_duplicates",
    """SELECT FeedbackId, SurveyType FROM (
         SELECT FeedbackId, SurveyType, row_number() OVER (PARTITION BY FeedbackId, SurveyType) AS copy FROM event_keys)
       WHERE copy > 1""",
)
def _(f):
    return quality.find_duplicates(f.view("event_keys"))


@query(
    "frames_equal",
    """SELECT (SELECT count(*) FROM (SELECT CommentId, DIM_DateId FROM eligible_day1 EXCEPT ALL SELECT CommentId, DIM_DateId FROM eligible_day2)) AS OnlyLeft,
              (SELECT count(*) FROM (SELECT CommentId, DIM_DateId FROM eligible_day2 EXCEPT ALL SELECT CommentId, DIM_DateId FROM eligible_day1)) AS OnlyRight,
              NOT EXISTS (SELECT 1 FROM (SELECT CommentId, DIM_DateId FROM eligible_day1 EXCEPT ALL SELECT CommentId, DIM_DateId FROM eligible_day2))
              AND NOT EXISTS (SELECT 1 FROM (SELECT CommentId, DIM_DateId FROM eligible_day2 EXCEPT ALL SELECT CommentId, DIM_DateId FROM eligible_day1)) AS "Equal" """,
)
def _(f):
    narrow = lambda day: f.eligible(day).select("CommentId", "DIM_DateId")
    return quality.frames_equal(narrow("day1"), narrow("day2"))


@query(
    "frames_equal_shuffled",
    """SELECT (SELECT count(*) FROM (SELECT CommentId, DIM_DateId FROM eligible_day1 EXCEPT ALL SELECT CommentId, DIM_DateId FROM eligible_day1)) AS OnlyLeft,
              (SELECT count(*) FROM (SELECT CommentId, DIM_DateId FROM eligible_day1 EXCEPT ALL SELECT CommentId, DIM_DateId FROM eligible_day1)) AS OnlyRight,
              NOT EXISTS (SELECT 1 FROM (SELECT CommentId, DIM_DateId FROM eligible_day1 EXCEPT ALL SELECT CommentId, DIM_DateId FROM eligible_day1)) AS "Equal" """,
)
def _(f):
    rows = f.eligible("day1").select("CommentId", "DIM_DateId")
    return quality.frames_equal(rows, rows.repartition("DIM_DateId").sortWithinPartitions("CommentId"))


@query(
    "conservation_check",
    f"""SELECT 'segment' AS Stage, 'comments = good + quarantined' AS "Check",
              (SELECT count(*) FROM answers_fact_survey) AS Expected, (SELECT count(*) FROM completed) AS Actual,
              (SELECT count(*) FROM answers_fact_survey) = (SELECT count(*) FROM completed) AS Ok
       UNION ALL SELECT 'cache', 'hits + misses = batch', (SELECT count(*) FROM dim),
              (SELECT count(*) FROM dim WHERE CommentId IN {_CACHED}) + (SELECT count(*) FROM dim WHERE CommentId NOT IN {_CACHED}),
              (SELECT count(*) FROM dim) = (SELECT count(*) FROM dim WHERE CommentId IN {_CACHED}) + (SELECT count(*) FROM dim WHERE CommentId NOT IN {_CACHED})
       UNION ALL SELECT 'report', 'fact = reported responses', (SELECT count(*) FROM reportable_day2),
              (SELECT count(DISTINCT FeedbackId) FROM final_report),
              (SELECT count(*) FROM reportable_day2) = (SELECT count(DISTINCT FeedbackId) FROM final_report)""",
)
def _(f):
    hits = segments.segment_cache_hits(cache(f), f.dim_state).select("CommentId").distinct()
    good = f.completed.filter("Status = 'ok'")
    checks = [
        quality.conservation_check(
            "segment", "comments = good + quarantined", [f.comment_texts],
            [good, completions.quarantine_rows(f.completed, DAY2)],
        ),
        quality.conservation_check(
            "cache", "hits + misses = batch", [f.dim_state],
            [hits, segments.segment_cache_misses(cache(f), f.dim_state)],
        ),
        quality.conservation_check(
            "report", "fact = reported responses", [f.reportable("day2")],
            [f.final_rows.select("FeedbackId").distinct()],
        ),
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


@query(
    "run_metrics",
    f"""SELECT 'report' AS Stage, Metric, Value::DOUBLE AS Value, {DAY2} AS RunDateId FROM (
          SELECT 'rows' AS Metric, count(*) AS Value FROM final_report
          UNION ALL SELECT 'responses', count(DISTINCT FeedbackId) FROM final_report
          UNION ALL SELECT 'segments', count(Segment) FROM final_report)""",
)
def _(f):
    return quality.run_metrics(
        f.final_rows, "report",
        {
            "rows": F.count(F.lit(1)),
            "responses": F.count_distinct("FeedbackId"),
            "segments": F.count("Segment"),
        },
        DAY2,
    )


@query(
    "source_profile",
    """SELECT (SELECT count(*) FROM fact_survey) AS SourceRows,
              (SELECT count(DISTINCT SurveyComment) FROM fact_survey) AS SourceDistinctComments,
              (SELECT sum(ResponseCount)::BIGINT FROM flagged_fact_survey) AS EligibleRows,
              (SELECT count(*) FROM flagged_fact_survey) AS EligibleDistinctComments,
              (SELECT sum(ResponseCount)::BIGINT FROM flagged_fact_survey WHERE IsNonresponse) AS NonresponseRows,
              (SELECT count(*) FROM flagged_fact_survey WHERE IsNonresponse) AS DistinctNonresponses""",
)
def _(f):
    return quality.source_profile(
        f.flagged("fact_survey"), shape.with_comment_id(f.view("fact_survey"))
    )


# ---------------------------------------------------------------- order, limits, sets


@query(
    "cumulative_coverage",
    f"SELECT {shown(['CommentId', 'SegmentNumber', 'Coverage', 'CumulativeCoverage'])} FROM segments",
)
def _(f):
    done = f.completed.filter("Status = 'ok'")
    return show(
        segments.segment_comments(done, DAY2),
        ["CommentId", "SegmentNumber", "Coverage", "CumulativeCoverage"],
    )


@query(
    "work_queue",
    "SELECT CommentId, LastResponseDate, ResponseCount FROM dim WHERE ProcessingDate IS NULL"
    " ORDER BY LastResponseDate DESC, ResponseCount DESC, CommentId LIMIT 500",
)
def _(f):
    return comments.work_queue(f.dim_state, 500).select("CommentId", "LastResponseDate", "ResponseCount")


@query("ordered_output", "SELECT CommentId, SegmentNumber, WorkloadLabel FROM labelled")
def _(f):
    rows = f.labelled.select("CommentId", "SegmentNumber", "WorkloadLabel")
    ordered = rows.repartition("CommentId").sortWithinPartitions("CommentId", "SegmentNumber")
    return store(f, "ordered").overwrite("labelled", ordered)


@query(
    "union_all",
    "SELECT FeedbackId, CommentId, DIM_DateId FROM eligible_day1 UNION ALL SELECT FeedbackId, CommentId, DIM_DateId FROM eligible_day2",
)
def _(f):
    first = f.eligible("day1").select("FeedbackId", "CommentId", "DIM_DateId")
    return first.union(f.eligible("day2").select("FeedbackId", "CommentId", "DIM_DateId"))


@query(
    "union_by_name",
    "SELECT DIM_DateId, LabelType, LabelValue, DistinctResponseCount FROM qc_before UNION ALL SELECT DIM_DateId, LabelType, LabelValue, DistinctResponseCount FROM qc_now",
)
def _(f):
    return f.qc_before.unionByName(f.qc_now.select(*reversed(f.qc_now.columns)))


@query(
    "distinct_rows",
    f"SELECT DISTINCT {shown(SHOWN)} FROM (SELECT {row_of()} FROM total UNION ALL SELECT {row_of()} FROM current)",
)
def _(f):
    both = f.total.select(*ROW).unionByName(f.current.select(*ROW))
    return show(report.distinct_rows(both), SHOWN)


_KEYS = "SELECT CommentId, DIM_DateId FROM eligible_day"


@query("except_all", f"{_KEYS}2 EXCEPT ALL {_KEYS}1")
def _(f):
    narrow = lambda day: f.eligible(day).select("CommentId", "DIM_DateId")
    return quality.except_all(narrow("day2"), narrow("day1"))


@query("except_distinct", f"{_KEYS}2 EXCEPT {_KEYS}1")
def _(f):
    narrow = lambda day: f.eligible(day).select("CommentId", "DIM_DateId")
    return quality.except_distinct(narrow("day2"), narrow("day1"))


# ---------------------------------------------------------------- text


@query("word_set", f"SELECT doc_id, unnest({words('text')}) AS word FROM documents")
def _(f):
    return f.table("documents").select("doc_id", F.explode(word_set(F.col("text"))).alias("word"))


@query(
    "segment_coverage",
    f"SELECT {shown(['CommentId', 'Segment', 'SegmentNumber', 'Coverage'])} FROM covered",
)
def _(f):
    rows = segments.explode_segments(f.completed.filter("Status = 'ok'"))
    return show(rows, ["CommentId", "Segment", "SegmentNumber", "Coverage"])


@query(
    "clean_segments",
    """SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY min(pos)) - 1 AS SegmentNumber, Segment
       FROM (SELECT doc_id, pos, trim(trim(trim(line, blanks), '-'), '"') AS Segment
             FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos, blanks
                   FROM (SELECT doc_id, string_split_regex(text, '@BREAKS@') AS lines, @BLANKS@ AS blanks FROM documents)))
       WHERE Segment <> '' GROUP BY doc_id, Segment""".replace("@BREAKS@", LINE_BREAKS).replace("@BLANKS@", BLANKS),
)
def _(f):
    return f.table("documents").select(
        "doc_id", F.posexplode(clean_segments(F.col("text"))).alias("SegmentNumber", "Segment")
    )


def template_sql(template: str) -> str:
    """The text a template renders, with the named columns joined in."""
    pieces = [p if i % 2 else quoted(p) for i, p in enumerate(re.split(r"\{(\w+)\}", template)) if p]
    return " || ".join(pieces)


def label_text_sql(kind: str, iteration: int) -> str:
    text = template_sql(prompts.label_template(kind))
    if prompts.takes_reason(kind, iteration):
        clause = template_sql(prompts.REASON_CLAUSE)
        text += f" || CASE WHEN length(Justification) > 1 THEN {clause} ELSE '' END"
    return text


TEXTED = "SELECT s.*, c.SurveyComment FROM labelled_raw s JOIN answers_fact_survey c USING (CommentId)"


@query(
    "label_prompts",
    " UNION ALL ".join(
        f"SELECT CommentId, SegmentNumber, '{t}' AS LabelType, {i} AS Round, length(Prompt) AS Size, md5(Prompt) AS Digest"
        f" FROM (SELECT CommentId, SegmentNumber, {label_text_sql(t, i)} AS Prompt FROM"
        " (SELECT *, CASE WHEN SegmentNumber % 2 = 0 THEN Segment ELSE ' ' END AS Justification FROM texted))"
        for t in LABEL_TYPES
        for i in (0, 1)
    ),
    {"texted": TEXTED},
)
def _(f):
    rows = f.with_text.withColumn(
        "Justification", F.when(F.col("SegmentNumber") % 2 == 0, F.col("Segment")).otherwise(" ")
    )
    rows = completions.per_label_type(rows, LABEL_TYPES)
    told = lambda i: completions.messages_by_type(rows, "assign", LABEL_TYPES, i).select(
        "CommentId", "SegmentNumber", "LabelType", F.lit(i).alias("Round"), F.col("Message")[1]["content"].alias("Prompt")
    )
    return told(0).unionByName(told(1)).select(
        "CommentId", "SegmentNumber", "LabelType", "Round", F.length("Prompt").alias("Size"), F.md5("Prompt").alias("Digest")
    )


@query(
    "validation_prompts",
    " UNION ALL ".join(
        f"SELECT CommentId, SegmentNumber, '{t}' AS LabelType, md5({template_sql(prompts.validation_template(t))}) AS Digest FROM texted"
        for t in VALIDATED_TYPES
    ),
    {"texted": TEXTED},
)
def _(f):
    rows = f.labelled_raw.join(f.comment_texts, "CommentId")
    out = None
    for kind in VALIDATED_TYPES:
        one = completions.validation_messages(rows, kind).select(
            "CommentId", "SegmentNumber", F.lit(kind).alias("LabelType"),
            F.md5(F.col("Message")[1]["content"]).alias("Digest"),
        )
        out = one if out is None else out.unionByName(one)
    return out


_SYSTEM = quoted(config.SEGMENT_SYSTEM)
_TEMPLATE = prompts.template_digest("segment", "All", prompts.SEGMENT_TEMPLATE)
_PROMPT_ID = f"sha256('{_TEMPLATE}' || chr(1) || CommentId)"


@query(
    "chat_messages",
    f"""SELECT CommentId, 0 AS Place, 'system' AS role, 'system' AS name, md5({_SYSTEM}) AS Digest FROM answers_day2
        UNION ALL SELECT CommentId, 1, 'user', 'user', md5(SurveyComment) FROM answers_day2""",
)
def _(f):
    messages = completions.segment_messages(f.stats("day2").select("CommentId", "SurveyComment"))
    return messages.select("CommentId", F.posexplode("Message").alias("Place", "m")).select(
        "CommentId", "Place", "m.role", "m.name", F.md5("m.content").alias("Digest")
    )


@query(
    "complete_messages",
    f"""SELECT CommentId, {_PROMPT_ID} AS PromptId, md5(answer) AS Digest,
               CASE Status WHEN 'ok' THEN 'stop' WHEN 'unfinished' THEN 'content_filter' END AS Reason,
               CASE WHEN Status = 'error' THEN '429' END AS Code
        FROM completed""",
)
def _(f):
    return f.completed.select(
        "CommentId", "PromptId", F.md5(F.get("content", F.lit(0))).alias("Digest"),
        F.get("finish_reason", F.lit(0)).alias("Reason"), F.col("error")["code"].alias("Code"),
    )


@query(
    "complete_messages_pipeline",
    f"""SELECT CommentId, md5(answer) AS Digest,
               CASE Status WHEN 'ok' THEN 'stop' WHEN 'unfinished' THEN 'content_filter' END AS Reason,
               CASE WHEN Status = 'error' THEN '429' END AS Code
        FROM completed""",
)
def _(f):
    """The same answers through a saved and loaded pipeline, by the messages themselves."""
    asked = completions.segment_messages(completions.segment_keys(f.comment_texts))
    answers = rules.rule_segments(asked).join(
        asked.select("PromptId", transformer.message_key(F.col("Message")).alias("_key")).dropDuplicates(["PromptId"]), "PromptId"
    )
    folder = scratch_path(f.spark, "answers")
    shape.conform(answers.withColumn("PromptId", F.col("_key")), COMPLETIONS).write.parquet(folder)
    stage = transformer.CompletionTransformer(messagesCol="Message", outputCol="Answer", errorCol="Failure", completionsPath=folder)
    place = scratch_path(f.spark, "pipeline")
    Pipeline(stages=[stage]).fit(asked).save(place)
    done = PipelineModel.load(place).transform(asked.select("CommentId", "Message"))
    return done.select(
        "CommentId", F.md5(F.get(F.col("Answer")["content"], F.lit(0))).alias("Digest"),
        F.get(F.col("Answer")["finish_reason"], F.lit(0)).alias("Reason"), F.col("Failure")["code"].alias("Code"),
    )


@query(
    "pending_prompts",
    f"""SELECT {_PROMPT_ID} AS PromptId, md5(SurveyComment) AS Digest FROM answers_day2
        WHERE CommentId NOT IN (SELECT CommentId FROM answers_day1)
           OR length(SurveyComment) % 53 = 0 OR length(SurveyComment) % 59 = 0""",
)
def _(f):
    keyed = lambda day: completions.segment_keys(f.stats(day).select("CommentId", "SurveyComment"))
    waiting = completions.pending_prompts(keyed("day2"), rules.rule_segments(keyed("day1")))
    asked = completions.segment_messages(waiting)
    return asked.select("PromptId", F.md5(F.col("Message")[1]["content"]).alias("Digest"))


@query(
    "single_label",
    "SELECT CommentId, SegmentNumber, CASE WHEN length(Segment) % 97 <> 0 THEN PlatformLabel END AS PlatformLabel FROM labelled_raw",
)
def _(f):
    rows = completions.single_label(f.label_answers("Platform"), "Platform")
    return rows.select("CommentId", "SegmentNumber", "PlatformLabel")


@query(
    "snap_to_vocabulary",
    f"SELECT CommentId, SegmentNumber, {', '.join(LABEL_COLUMNS)} FROM snapped",
)
def _(f):
    return labels.snap_to_vocabulary(f.labelled_raw).select("CommentId", "SegmentNumber", *LABEL_COLUMNS)


FLOOR = 0.9
REJECTED = {
    f"best_{t}": f"""
        SELECT raw, label, s FROM (
            SELECT raw, label, s, row_number() OVER (PARTITION BY raw ORDER BY s DESC, rank) AS place FROM (
                SELECT raw, label, rank, {score(norm('raw'), norm('label'))} AS s
                FROM (SELECT DISTINCT {t}Label AS raw FROM labelled_raw WHERE {t}Label IS NOT NULL),
                     (SELECT unnest({sql_list(config.vocabulary(t))}) AS label, generate_subscripts({sql_list(config.vocabulary(t))}, 1) AS rank)))
        WHERE place = 1 AND s < {FLOOR} AND raw NOT IN ({", ".join(quoted(e) for e in config.vocabulary(t))})"""
    for t in LABEL_TYPES
}


@query(
    "rejected_labels",
    " UNION ALL ".join(
        f"SELECT CommentId, SegmentNumber, '{t}' AS LabelType, raw AS RawLabel, label AS Closest, round(s, 6) AS Score"
        f" FROM labelled_raw JOIN best_{t} ON {t}Label = raw"
        for t in LABEL_TYPES
    ),
    REJECTED,
)
def _(f):
    return labels.rejected_labels(f.labelled_raw, FLOOR).withColumn("Score", F.round("Score", 6))


VALIDATION = {
    "said": """
        SELECT CommentId, SegmentNumber, Segment, SentimentLabel,
               CASE length(Segment) % 5 WHEN 0 THEN 'Agree'
                    WHEN 1 THEN 'disagree' || chr(10) || 'The label ' || SentimentLabel || ' is wrong.'
                    WHEN 2 THEN 'Disagree. No sign of it'
                    WHEN 3 THEN 'Disagree' || chr(10) || 'I find the label ' || SentimentLabel || ' is accurate.'
                    ELSE 'Agree.' || chr(10) || 'It fits.' END AS answer
        FROM snapped""",
    "halves": """
        SELECT *, split_part(answer, chr(10), 1) AS line,
               CASE WHEN contains(answer, chr(10)) THEN substr(answer, instr(answer, chr(10)) + 1) END AS rest
        FROM said""",
    "verdicts": snap_table("SELECT DISTINCT line AS raw FROM halves", config.CONSENSUS_VALUES),
    "parsed": r"""
        SELECT CommentId, SegmentNumber, Segment, SentimentLabel, label AS Consensus,
               coalesce(rest, CASE WHEN length(remainder) > 1 THEN remainder ELSE ' ' END) AS Justification
        FROM (SELECT h.*, label, regexp_replace(regexp_replace(replace(line, label, ''), '^\. ', ''), '^\.', '') AS remainder
              FROM halves h JOIN verdicts v ON h.line = v.raw)""",
    "judged": "SELECT CommentId, SegmentNumber, Segment, SentimentLabel,"
    " CASE WHEN contradicts THEN 'Agree' ELSE Consensus END AS Consensus,"
    f" CASE WHEN contradicts THEN {quoted(config.CONTRADICTION_NOTE)} ELSE Justification END AS Justification"
    " FROM (SELECT *, Consensus = 'Disagree' AND ("
    + " OR ".join(f"Justification LIKE {quoted(p)}" for p in config.CONTRADICTION_PATTERNS)
    + ") AS contradicts FROM parsed)",
}


def sentiment_answers(f: Frames) -> DataFrame:
    rows = labels.snap_to_vocabulary(f.labelled_raw, ["Sentiment"])
    return rows.withColumn("answer", rules.validation_text(F.col("SentimentLabel")))


@query("parse_consensus", "SELECT CommentId, SegmentNumber, Consensus, Justification FROM parsed", VALIDATION)
def _(f):
    parsed = sentiment_answers(f).withColumn("v", labels.parse_consensus(F.col("answer")))
    return parsed.select("CommentId", "SegmentNumber", "v.Consensus", "v.Justification")


@query("contradiction_override", "SELECT CommentId, SegmentNumber, Consensus, Justification FROM judged", VALIDATION)
def _(f):
    rows = sentiment_answers(f).withColumn(
        "v", labels.contradiction_override(labels.parse_consensus(F.col("answer")))
    )
    return rows.select("CommentId", "SegmentNumber", "v.Consensus", "v.Justification")


_MOODS = config.vocabulary("Sentiment")
_SECOND = f"list_extract([{', '.join(map(quoted, _MOODS))}], (length(Segment) + 1) % {len(_MOODS)} + 1)"


@query(
    "relabel_round",
    f"""SELECT CommentId, SegmentNumber, SentimentLabel AS SentimentLabel_iteration0,
               CASE WHEN Consensus = 'Agree' THEN 0 ELSE 1 END AS Sentiment_iteration,
               CASE WHEN Consensus = 'Agree' THEN SentimentLabel ELSE {_SECOND} END AS SentimentLabel
        FROM judged WHERE CommentId NOT IN (SELECT CommentId FROM judged WHERE Consensus <> 'Agree' AND length(Segment) % 97 = 0)""",
    VALIDATION,
)
def _(f):
    rows = labels.validated(
        sentiment_answers(f).withColumn("content", F.array("answer")), "Sentiment"
    )
    open_rows = rows.filter(~labels.agreed("Sentiment")).withColumn(
        "Justification", F.col("SentimentLabel_validation")["Justification"]
    )
    keyed = completions.label_keys(open_rows, "Sentiment", 1)
    answers = completions.triage(
        completions.complete_messages(keyed, rules.rule_labels(keyed, "Sentiment", 1))
    ).filter("Status = 'ok'")
    second = labels.snap_to_vocabulary(completions.single_label(answers, "Sentiment"), ["Sentiment"])
    return labels.relabel_round(rows, second, "Sentiment").select(
        "CommentId", "SegmentNumber", "SentimentLabel_iteration0", "Sentiment_iteration", "SentimentLabel"
    )


@query(
    "vocabulary_table",
    """SELECT doc_id, pos - 1 AS Rank, entry AS Label FROM (
         SELECT doc_id, unnest(inner_lines) AS entry, generate_subscripts(inner_lines, 1) AS pos
         FROM (SELECT doc_id, string_split(text, chr(10))[2:-2] AS inner_lines FROM documents
               WHERE len(string_split(text, chr(10))) > 2))""",
)
def _(f):
    return labels.vocabulary_table(f.table("documents"), "doc_id", "text")


@query(
    "system_prompt_table",
    " UNION ALL ".join(
        f"SELECT CommentId, SegmentNumber, 'assign' AS Stage, '{t}' AS LabelType,"
        f" {quoted(config.SYSTEM_PROMPTS[('assign', t)])} AS Instruction FROM labelled_raw"
        for t in LABEL_TYPES
    ),
)
def _(f):
    work = long_labels(f).select(
        "CommentId", "SegmentNumber", F.lit("assign").alias("Stage"), "LabelType"
    )
    return labels.instructions(work, config.system_prompt_frame(f.spark), ["Stage", "LabelType"])
