"""Two days of one survey, with a removal, a restatement, a repeat and a fuzzy duplicate."""

import pytest
from pyspark.sql import functions as F

from checks.rules import rule_answer
from earshot.functions.text import comment_id
from earshot.plans.daily import Run, comment_dim, run_day
from earshot.schemas import FACT_SURVEY
from earshot.session import scratch_path
from earshot.sources.tables import TableStore

GOOD = "The reports load fast\nbut the price is high"
HELP = "Support answered my ticket within a day"
LATE = "Please add a dark theme to the settings page soon"


def row(i, text, date=20240101, kind="NPS", internal="False", product=10, score=5):
    return (str(i), text, kind, internal, product, date, score)


DAY1 = [
    row(1, GOOD), row(2, HELP), row(3, None), row(4, ""), row(5, "?"), row(6, GOOD, 20240102),
    row(7, "internal remark on the reports", internal="True"),
    row(8, "another product has reports", product=99),
    row(9, "old reports were slow", 20221231), row(10, "csat reports", kind="CSAT"),
]
# 2 is withdrawn, 1 is restated, 11 repeats a known text, 12 is new and nearly equal to it,
# 13 is new altogether.
DAY2 = [r for r in DAY1 if r[0] not in ("1", "2")] + [
    row(1, GOOD, 20240105, score=9), row(11, GOOD, 20240106), row(12, GOOD + "!", 20240106),
    row(13, LATE, 20240106),
]


@pytest.fixture(scope="module")
def days(spark):
    store = TableStore(spark, scratch_path(spark, "daily"))
    dictionary = spark.createDataFrame([(w,) for w in ("reports", "support", "settings")], "word string")
    context = spark.createDataFrame([("1", "a,b"), ("1", "a,c"), ("13", None)], "FeedbackId string, Value string")
    fact1 = spark.createDataFrame(DAY1, FACT_SURVEY)
    fact2 = spark.createDataFrame(DAY2, FACT_SURVEY)
    texts = fact2.unionByName(fact1).select(comment_id(F.col("SurveyComment")).alias("CommentId"), "SurveyComment")
    near = F.when(F.startswith("SurveyComment", F.lit(GOOD)), F.array(F.lit(1.0), F.lit(0.0)))
    vectors = (
        texts.filter("SurveyComment <> ''").distinct()
        .select("CommentId", near.otherwise(F.array(F.lit(0.0), F.lit(1.0))).alias("Vector"))
    )
    out = {}
    for name, fact, date in (("day1", fact1, 20240110), ("day2", fact2, 20240111), ("again", fact2, 20240111)):
        run = Run("NPS", date, 20230101, rule_answer)
        run_day(store, fact, dictionary, context, run, vectors)
        out[name] = {
            "report": [r.asDict() for r in store.read("report_NPS").collect()],
            "dim": {r["SurveyComment"]: r.asDict() for r in comment_dim(store, run).collect()},
            "qc": store.read("qc_NPS").count(),
        }
    out["store"] = store
    return out


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r["FeedbackId"], []).append(r)
    return out


def test_first_day(days):
    rows = by_id(days["day1"]["report"])
    assert set(rows) == {"1", "2", "3", "4", "5", "6"}
    assert [r["Segment"] for r in sorted(rows["1"], key=lambda r: r["SegmentNumber"])] == GOOD.split("\n")
    assert {r["ReportingType"] for i in "34" for r in rows[i]} == {"Empty"}
    assert rows["5"][0]["ReportingType"] == "Nonresponse" and rows["5"][0]["Segment"] is None
    assert all(r["SurveyType"] == "NPS" for r in days["day1"]["report"])
    good = days["day1"]["dim"][GOOD]
    assert (good["FirstResponseDate"], good["LastResponseDate"], good["ResponseCount"]) == (20240101, 20240102, 2)
    assert good["ProcessingDate"] == good["ReportingDate"] == 20240110


def test_removal_restatement_repeat_duplicate(days):
    rows = by_id(days["day2"]["report"])
    assert "2" not in rows and HELP not in days["day2"]["dim"]
    assert {(r["DIM_DateId"], r["Score"]) for r in rows["1"]} == {(20240105, 9)}
    labels = lambda i: {(r["Segment"], r["SentimentLabel"], r["WorkloadLabel"]) for r in rows[i]}
    assert labels("11") == labels("1") == labels("6") == labels("12")
    assert {r["SurveyComment"] for r in rows["12"]} == {GOOD + "!"}
    assert len(rows["13"]) == 1 and rows["13"][0]["ReportingType"] == "Report"
    assert days["day2"]["dim"][GOOD + "!"]["ProcessingDate"] == 20240111


def test_context_does_not_multiply_rows(days):
    rows = by_id(days["day2"]["report"])
    assert len(rows["1"]) == 2 and {r["UserContext"] for r in rows["1"]} == {"a,b,c"}
    assert rows["13"][0]["UserContext"] == "" and rows["6"][0]["UserContext"] is None


def test_duplicate_map_is_stamped(days):
    pairs = days["store"].read("duplicate_map_NPS").collect()
    assert [(r["SurveyComment"], r["SurveyCommentDeduped"], r["ReportingDate"]) for r in pairs] == [
        (GOOD + "!", GOOD, 20240111)
    ]


def test_second_run_changes_nothing(days):
    key = lambda r: sorted((k, repr(v)) for k, v in r.items())
    assert sorted(map(key, days["again"]["report"])) == sorted(map(key, days["day2"]["report"]))
    assert days["again"]["dim"] == days["day2"]["dim"]
    assert days["again"]["qc"] == days["day2"]["qc"]


def test_balances_hold(days):
    store = days["store"]
    for date, stage in ((20240110, "intake"), (20240110, "segmentation"), (20240110, "labelling"), (20240110, "relabelling"), (20240111, "report")):
        rows = store.read(f"checks/{date}/{stage}_NPS").collect()
        assert rows and all(r["Ok"] for r in rows), rows


def test_metrics_are_kept(days):
    rows = days["store"].read("metrics/20240110/labelling_NPS").collect()
    values = {(r["Stage"], r["Metric"]): r["Value"] for r in rows}
    assert values[("labelling", "seconds")] > 0
    assert values[("labelling Sentiment", "rows")] == values[("labelling Sentiment", "ok")] == 3
