"""The report in buckets: the earlier report is not exchanged, and versions keep their number of buckets."""

import re

from pyspark.sql import functions as F

from earshot.operators import report
from earshot.schemas import REPORT, REPORT_OUT
from earshot.session import _BUCKETED, scratch_path
from earshot.sources.tables import TableStore

KINDS = ("Report", "Nonresponse", "Empty")


def prior_rows(spark, n=4000):
    i = F.col("id")
    row = spark.range(n).select(
        F.lit(20240101).alias("DIM_DateId"), F.lit(10).alias("DIM_ProductMasterId"), (i % 1500).cast("string").alias("FeedbackId"),
        F.sha2((i % 90).cast("string"), 256).alias("CommentId"), F.concat(F.lit("segment "), i % 1500).alias("Segment"), F.floor(i / 1500).alias("SegmentNumber"),
        F.lit(0.5).alias("Coverage"), F.lit(1.0).alias("CumulativeCoverage"), F.lit("Positive").alias("SentimentLabel"), F.lit("Weather Watch").alias("WorkloadLabel"),
        F.lit("No").alias("SupportLabel"), F.lit("Web").alias("PlatformLabel"), F.lit(3).alias("Score"), F.lit("Report").alias("ReportingType"),
        F.lit("Weather Watch").alias("WorkloadLabel_original"), F.lit(None).cast("string").alias("UserContext"), F.concat(F.lit("text "), i % 90).alias("SurveyComment"),
    )
    return row.select(*[F.col(f.name).cast(f.dataType) for f in REPORT.fields], "SurveyComment")


def exchanged_scans(df, name):
    """Lines of the plan that scan ``name`` below an exchange."""
    text = df._jdf.queryExecution().executedPlan().toString()
    lines, found = text.split("\n"), []
    for n, line in enumerate(lines):
        if "FileScan" in line and name in line:
            depth = len(re.match(r"[ :+\-*()0-9]*", line).group())
            for above in reversed(lines[:n]):
                here = len(re.match(r"[ :+\-*()0-9]*", above).group())
                if here < depth:
                    depth = here
                    if re.match(r"[ :+\-*()0-9]*(Exchange|BroadcastExchange)", above):
                        found.append(line)
    return found


def test_the_earlier_report_is_not_exchanged(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = TableStore(spark, scratch_path(spark, "buckets"))
        rows = prior_rows(spark)
        prior = store.overwrite_bucketed("report", rows.repartition(8, "FeedbackId"), "FeedbackId", 8)
        name = "Segment#"  # only the earlier report is read from files
        ids = spark.range(200, 1600).select(F.col("id").cast("string").alias("FeedbackId"))
        fact = ids.select(F.lit(20240103).alias("DIM_DateId"), F.lit(10).alias("DIM_ProductMasterId"), "FeedbackId", F.sha2("FeedbackId", 256).alias("CommentId"), F.lit(7).alias("Score"))
        current = rows.filter("CAST(FeedbackId AS INT) < 300").limit(500)
        restated = report.restate_prior_report(fact, prior)
        total = report.supersede_prior(current.repartition(8, "FeedbackId"), restated, dedupe=False)
        context = ids.select("FeedbackId", F.lit("a,b").alias("UserContext"))
        out = report.enrich_context(report.drop_removed_feedback(restated, fact), context).distinct()
        for df in (restated, report.drop_removed_feedback(restated, fact), out, total):
            assert name in df._jdf.queryExecution().executedPlan().toString()
            assert not exchanged_scans(df, name)
        plain = spark.read.parquet(store.path("report/version=1"))
        want = report.restate_prior_report(fact, plain)
        assert exchanged_scans(want, name)  # without buckets it would be
        assert restated.exceptAll(want).isEmpty() and want.exceptAll(restated).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_versions_and_bucket_counts(spark):
    store = TableStore(spark, scratch_path(spark, "buckets"))
    assert store.read_bucketed("report", REPORT_OUT).count() == 0
    rows = prior_rows(spark, 300)
    for buckets in (3, 5, 4):
        kept = store.overwrite_bucketed("report", rows.repartition(buckets, "FeedbackId"), "FeedbackId", buckets)
        assert kept.count() == 300 and kept.groupBy("FeedbackId").count().rdd.getNumPartitions() >= 1
        assert store.read("report", rows.schema).count() == 300  # a plain reader sees the same rows
    kept_versions = {p.rsplit("=", 1)[1] for p in _BUCKETED if p.startswith(store.path("report"))}
    assert kept_versions <= {"2", "3"}
    # an unbucketed version is read as it is
    store.overwrite("report", rows.limit(7))
    assert store.read_bucketed("report", rows.schema).count() == 7


def test_rows_already_settled_are_left_out(spark):
    schema = "FeedbackId string, a int, b string, SurveyComment string"
    settled = spark.createDataFrame([("1", 1, None, "x"), ("1", 2, "y", "x"), ("2", 1, "z", None)], schema)
    fresh = spark.createDataFrame([("1", 1, None), ("1", 1, "q"), ("2", 2, "z"), ("3", 1, None), (None, 1, None)], "FeedbackId string, a int, b string")
    got = report.not_yet_in(fresh, settled).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [("1", 1, "q"), ("2", 2, "z"), ("3", 1, None), (None, 1, None)]))


def test_rows_without_a_comment_take_no_part_in_the_text_join(spark):
    from earshot.functions.text import comment_id

    empty = spark.range(1).select(comment_id(F.lit(""))).head()[0]
    rows = spark.createDataFrame([("1", empty, 1), ("2", None, 1), ("3", "c", 1), ("4", "gone", 1)], "FeedbackId string, CommentId string, SegmentNumber long")
    texts = spark.createDataFrame([("c", "said")], "CommentId string, SurveyComment string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = report.attach_text(rows, texts)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        # the side of the join is filtered before it
        assert re.search(r"Join LeftOuter(.|\n)*Filter(.|\n)*NOT", plan) or "isnotnull(CommentId" in plan
        assert {r["FeedbackId"]: r["SurveyComment"] for r in out.collect()} == {"1": "", "2": None, "3": "said", "4": None}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
