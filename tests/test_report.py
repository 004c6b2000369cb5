"""Report rules that need more than one run or survey type to show."""

from pyspark.sql import functions as F

from earshot.functions.text import comment_id
from earshot.operators import comments, quality, report, segments, shape
from earshot.schemas import COMMENT_DIM, REPORT


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stored_label_survives_a_second_report(spark):
    df = spark.createDataFrame([("Planting Plan",), ("Weather Watch",), ("unheard of",)], "WorkloadLabel string")
    once = shape.predicted_product_id(df)
    twice = shape.predicted_product_id(once)
    want = [("Planting", "Planting Plan", 10), ("Weather", "Weather Watch", 11), (None, "unheard of", None)]
    columns = ["WorkloadLabel", "WorkloadLabel_original", "Predicted_DIM_ProductMasterId"]
    assert rows(once.select(columns)) == rows(twice.select(columns)) == sorted(want, key=repr)


def test_dimension_is_kept_per_survey_type(spark):
    fact = spark.createDataFrame(
        [("NPS", "c", "text", 1), ("CSAT", "c", "text", 2), ("NPS", "c", "text", 3)],
        "SurveyType string, CommentId string, SurveyComment string, DIM_DateId int",
    )
    known = spark.createDataFrame([], COMMENT_DIM)
    dim = comments.upsert_comment_dim(comments.comment_stats(fact), known)
    assert rows(dim.select("SurveyType", "FirstResponseDate", "LastResponseDate", "ResponseCount")) == [
        ("CSAT", 2, 2, 1), ("NPS", 1, 3, 2)
    ]
    gone = comments.drop_removed_comments(dim, fact.filter("SurveyType = 'NPS'"))
    assert [r["SurveyType"] for r in gone.collect()] == ["NPS"]


def test_lost_comments_show_in_the_balance(spark):
    done = spark.createDataFrame(
        [("a", "text", ["---text"]), ("b", "text", ["---"])],
        "CommentId string, SurveyComment string, content array<string>",
    )
    kept = segments.segment_comments(done, 20240101).select("CommentId").distinct()
    check = quality.conservation_check("segmentation", "good = segmented", [done], [kept]).head()
    assert (check["Expected"], check["Actual"], check["Ok"]) == (2, 1, False)


def test_texts_come_from_the_fact_or_the_earlier_report(spark):
    text = spark.createDataFrame([("now",), ("",)], "SurveyComment string").select(
        comment_id(F.col("SurveyComment")).alias("CommentId"), "SurveyComment"
    )
    before = spark.createDataFrame([("old",)] * 3, "SurveyComment string").select(
        comment_id(F.col("SurveyComment")).alias("CommentId"), "SurveyComment"
    )
    texts = report.comment_texts([text.filter("SurveyComment <> ''")], before.unionByName(text.filter("SurveyComment = 'now'")))
    assert sorted(r["SurveyComment"] for r in texts.collect()) == ["now", "old"]
    empty = spark.createDataFrame([(None, "1", 0)], "CommentId string, FeedbackId string, SegmentNumber int")
    named = text.unionByName(before.limit(1)).select("CommentId", F.lit("1").alias("FeedbackId"), F.lit(0).alias("SegmentNumber"))
    got = report.attach_text(named.unionByName(empty), texts)
    assert sorted(str(r["SurveyComment"]) for r in got.collect()) == ["", "None", "now", "old"]


def test_only_the_covered_product_of_a_response_is_superseded(spark):
    def frame(data):
        given = spark.createDataFrame(data, "FeedbackId string, DIM_ProductMasterId int, Segment string")
        return shape.typed_backfill(given, REPORT).select(*REPORT.names)

    current = frame([("1", 10, "new"), ("1", 10, "new")])
    prior = frame([("1", 10, "old"), ("1", 11, "old"), ("2", 10, "old"), ("2", None, "old")])
    total = report.supersede_prior(current, prior).select("FeedbackId", "DIM_ProductMasterId", "Segment")
    assert rows(total) == sorted(
        [("1", 10, "new"), ("1", 11, "old"), ("2", 10, "old"), ("2", None, "old")], key=repr
    )


def test_empty_responses_by_text_or_by_id(spark):
    fact = spark.createDataFrame([("1", None), ("2", ""), ("3", "x")], "FeedbackId string, SurveyComment string")
    keyed = shape.with_comment_id(fact)
    by_text = shape.empty_responses(keyed).select("FeedbackId", "ReportingType")
    by_id = shape.empty_responses(keyed.drop("SurveyComment")).select("FeedbackId", "ReportingType")
    assert rows(by_text) == rows(by_id) == [("1", "Empty"), ("2", "Empty")]
