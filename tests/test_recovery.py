"""Runs that die, answers that fail, and stages that lose rows."""

import pytest
from pyspark.sql import functions as F

from checks.rules import rule_answer
from earshot.operators import comments, labels
from earshot.plans import daily
from earshot.plans.daily import BalanceError, Run, comment_dim, run_day
from earshot.schemas import COMPLETIONS, FACT_SURVEY
from earshot.session import scratch_path
from earshot.sources.tables import TableStore

SECOND = "but the price is high"
GOOD = f"The reports load fast\n{SECOND}"  # the rule disagrees with the first labels of both segments
HELP = "Support answered my ticket within a day"


@pytest.fixture(scope="module")
def inputs(spark):
    rows = [(str(i), text, "NPS", "False", 10, 20240101 + i, i) for i, text in enumerate([GOOD, HELP, GOOD, None])]
    fact = spark.createDataFrame(rows, FACT_SURVEY)
    words = spark.createDataFrame([(w,) for w in ("reports", "support")], "word string")
    context = spark.createDataFrame([("0", "a")], "FeedbackId string, Value string")
    return fact, words, context


def report(store):
    columns = ["FeedbackId", "SegmentNumber", "Segment", "SentimentLabel", "WorkloadLabel", "PlatformLabel", "ReportingType"]
    return sorted((tuple(r) for r in store.read("report_NPS").select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def undisturbed(spark, inputs):
    store = TableStore(spark, scratch_path(spark, "undisturbed"))
    run_day(store, *inputs, Run("NPS", 20240110, 20230101, rule_answer))
    return report(store)


def test_failing_second_answer_keeps_the_comment_whole(spark, inputs, undisturbed):
    store = TableStore(spark, scratch_path(spark, "second"))
    asked_for = []

    def answer(asked, stage, kind, iteration):
        out = rule_answer(asked, stage, kind, iteration)
        asked_for.append((len(days), stage, kind, iteration, asked.count()))
        if iteration == 1 and kind == "Workload" and len(days) == 1:
            bad = asked.filter(F.col("Segment") == SECOND).select("PromptId", F.lit(True).alias("bad"))
            error = F.struct(F.lit("429").alias("code"), F.lit("busy").alias("message"))
            out = out.join(bad, "PromptId", "left").withColumns(
                {
                    "content": F.when(F.col("bad").isNull(), F.col("content")),
                    "finish_reason": F.when(F.col("bad").isNull(), F.col("finish_reason")),
                    "error": F.when(F.col("bad"), error).otherwise(F.col("error")),
                }
            )
        return out.select(*COMPLETIONS.names)

    days = [1]
    run_day(store, *inputs, Run("NPS", 20240110, 20230101, answer))
    assert {r[0] for r in report(store) if r[6] == "Report"} == {"1"}
    dim = {r.SurveyComment: r for r in comment_dim(store, Run("NPS", 20240110, 20230101, answer)).collect()}
    assert dim[GOOD].ProcessingDate is None and dim[HELP].ReportingDate == 20240110
    days.append(2)
    run_day(store, *inputs, Run("NPS", 20240111, 20230101, answer))
    assert report(store) == undisturbed
    # on the second day, only the prompt that failed is asked
    assert [(s, k, i, n) for d, s, k, i, n in asked_for if d == 2] == [("assign", "Workload", 1, 1)]


@pytest.mark.parametrize("later", [20240110, 20240112])
@pytest.mark.parametrize("stage", ["intake", "labelling", "relabelling", "mark_reported"])
def test_cut_runs_are_made_good(spark, inputs, undisturbed, monkeypatch, stage, later):
    store = TableStore(spark, scratch_path(spark, f"cut-{stage}"))

    class Cut(Exception):
        pass

    home = comments if stage == "mark_reported" else daily
    whole = getattr(home, stage)

    def cut(*args, **kwargs):
        if stage != "mark_reported":
            whole(*args, **kwargs)
        raise Cut

    with monkeypatch.context() as patch:
        patch.setattr(home, stage, cut)
        with pytest.raises(Cut):
            run_day(store, *inputs, Run("NPS", 20240110, 20230101, rule_answer))
    run_day(store, *inputs, Run("NPS", later, 20230101, rule_answer))
    assert report(store) == undisturbed
    dim = comment_dim(store, Run("NPS", later, 20230101, rule_answer)).collect()
    assert all(r.ProcessingDate and r.ReportingDate for r in dim)
    assert store.read("labelled_NPS").count() == 0


def test_lost_rows_stop_the_run(spark, inputs, monkeypatch):
    store = TableStore(spark, scratch_path(spark, "lost"))
    whole = labels.relabel_round
    with monkeypatch.context() as patch:
        patch.setattr(labels, "relabel_round", lambda rows, second, kind: whole(rows, second, kind).filter("SegmentNumber < 1"))
        with pytest.raises(BalanceError, match="relabelling"):
            run_day(store, *inputs, Run("NPS", 20240110, 20230101, rule_answer))
    run = Run("NPS", 20240110, 20230101, rule_answer)
    assert not any(r.ProcessingDate for r in comment_dim(store, run).collect())
    failed = store.read("checks/20240110/relabelling_NPS").filter("NOT Ok").collect()
    assert failed and all(r["Expected"] != r["Actual"] for r in failed)


def test_alerts_are_stored(spark, inputs):
    store = TableStore(spark, scratch_path(spark, "alerts"))
    run_day(store, *inputs, Run("NPS", 20240110, 20230101, rule_answer))
    fact, words, context = inputs
    run_day(store, fact.filter("FeedbackId <> '1'"), words, context, Run("NPS", 20240111, 20230101, rule_answer))
    alerts = store.read("alerts/20240111/drift_NPS").collect()
    assert any(r.IssueFlag for r in alerts)


def test_partition_survives_a_failing_write_and_may_be_read_while_replaced(spark):
    store = TableStore(spark, scratch_path(spark, "partition"))
    rows = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "k int, d int")
    store.overwrite_partition("t", rows.filter("d = 7"), {"d": 7})
    store.overwrite_partition("t", rows.filter("d = 8"), {"d": 8})
    failing = rows.filter("d = 7").withColumn("k", F.when(F.col("k") == 2, F.raise_error(F.lit("dead"))).otherwise(F.col("k")).cast("int"))
    with pytest.raises(Exception, match="dead"):
        store.overwrite_partition("t", failing, {"d": 7})
    own = store.read_partition("t", rows.schema, {"d": 7})
    assert sorted(r.k for r in own.collect()) == [1, 2]
    store.overwrite_partition("t", own.withColumn("k", F.col("k") + 10), {"d": 7})
    assert sorted((r.k, r.d) for r in store.read("t", rows.schema).collect()) == [(3, 8), (11, 7), (12, 7)]
