"""What the stage tables hold, and the report in buckets when repeats are dropped."""

import hashlib
import os
import time

from pyspark.sql import functions as F

from checks.frames import Frames
from earshot.operators import comments, labels, report
from earshot.schemas import COMMENT_STATE, LABEL_TYPES, REPORT, REPORT_OUT
from earshot.session import free_shuffles, joined_in_place, persist_bucketed, shared_dir
from tests.test_buckets import exchanged_scans, prior_rows


def test_work_state_and_report_rows_hold_no_texts(spark):
    frames = Frames(spark, "/root/testdata/sf0.001")
    for rows in (frames.known_state, frames.dim_state, frames.dim_done, frames.prior_rows, frames.total, frames.final_rows):
        assert "SurveyComment" not in rows.columns
    assert frames.final_report.columns == REPORT_OUT.names
    named = frames.final_report.filter("SurveyComment <> ''")
    assert named.filter(F.sha2("SurveyComment", 256) != F.col("CommentId")).isEmpty() and not named.isEmpty()
    assert frames.final_report.count() == frames.final_rows.count()


def test_state_without_texts_is_the_dimension_without_its_texts(spark):
    fact = spark.createDataFrame(
        [("NPS", "a", "one text", 1), ("NPS", "a", "one text", 3), ("NPS", "b", "x", 2)],
        "SurveyType string, CommentId string, SurveyComment string, DIM_DateId int",
    )
    known = spark.createDataFrame([], COMMENT_STATE)
    bare = comments.with_character_count(fact).drop("SurveyComment")
    state = comments.upsert_comment_dim(comments.comment_stats(bare), known)
    whole = comments.upsert_comment_dim(comments.comment_stats(fact), known)
    assert sorted(state.collect()) == sorted(whole.drop("SurveyComment").collect())
    words = spark.createDataFrame([("text",)], "word string")
    flags = comments.nonresponse_flags(comments.comment_stats(fact), words)
    assert flags.columns == ["CommentId", "IsNonresponse"]
    split = comments.nonresponse_split(comments.comment_stats(fact), words).select(*flags.columns)
    assert sorted(flags.collect()) == sorted(split.collect()) == [("a", False), ("b", True)]


def test_repeats_over_two_bucketed_tables_are_dropped(spark):
    rows = prior_rows(spark, 300).select(*REPORT.names)
    kept = [persist_bucketed(rows.filter(c).repartition(8, "FeedbackId"), "twice", "FeedbackId", 8) for c in ("FeedbackId < 290", "FeedbackId > 5")]
    assert report.distinct_rows(kept[0].unionByName(kept[1])).count() == 300


def test_superseding_drops_repeats_without_an_exchange_of_the_report(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = prior_rows(spark, 600).select(*REPORT.names)
        lacking = rows.limit(40).withColumn("DIM_ProductMasterId", F.lit(None).cast("int"))
        nameless = rows.limit(3).withColumn("FeedbackId", F.lit(None).cast("string"))
        both = lacking.unionByName(nameless)
        prior = rows.unionByName(rows.limit(50)).unionByName(both).unionByName(both)
        current = rows.filter("CAST(FeedbackId AS INT) < 100").withColumn("Score", F.lit(9)).unionByName(both)
        current = current.unionByName(current)
        dealt = [persist_bucketed(df.repartition(8, "FeedbackId"), "dealt", "FeedbackId", 8) for df in (current, prior)]
        total = report.supersede_prior(*dealt)
        # only rows without a response, of which there are few, are brought together as a whole
        heavy = [line for line in exchanged_scans(total, "Segment#") if "isnull(FeedbackId" not in line]
        assert not heavy
        loose = report.supersede_prior(current, prior, dedupe=False).distinct()
        assert total.count() == loose.count() == 600 + 43
        assert total.exceptAll(loose).isEmpty() and loose.exceptAll(total).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_labels_join_segments_where_they_lie_and_texts_are_exchanged_once(spark):
    frames = Frames(spark, "/root/testdata/sf0.001")
    body, wide = frames.segments.select(*labels.SEGMENT_KEY, *labels.SEGMENT_BODY), frames.segment_labels
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with joined_in_place(spark):
            joined = labels.join_on(body, wide, labels.SEGMENT_KEY)
            assert not exchanged_scans(joined, "Segment#") and joined.count() == wide.count() > 0
        done = frames.completed.select("CommentId", "SurveyComment", "content")
        done.collect()
        assert "ReusedExchange" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_what_only_stored_stages_have_read_is_deleted(spark):
    frames = Frames(spark, "/root/testdata/sf0.001")
    assert frames.prior_rows.count() and frames.labelled.count()
    left = os.listdir(shared_dir(spark).removeprefix("file:"))
    assert not [name for name in left if name.startswith(("current_day1-", *(f"answers_{kind}-" for kind in LABEL_TYPES)))]


def test_shuffle_files_of_a_finished_job_are_freed(spark):
    held = lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    spark.range(1000).repartition(7, "id").write.format("noop").mode("overwrite").save()
    before = held()
    free_shuffles(spark)
    until = time.monotonic() + 20
    while held() >= before and time.monotonic() < until:
        time.sleep(0.2)
    assert held() < before


def test_a_text_is_dealt_out_once_for_each_response(spark):
    columns = "FeedbackId string, CommentId string, Segment string, SegmentNumber long"
    rows = [(f"r{k}", f"c{k % 5}", f"s{n}", n) for k in range(40) for n in range(4)]
    rows += [("r1", "c9", "other", 0), (None, "c1", "s0", 0), (None, None, None, None), ("r2", None, None, None), ("r3", "none", "s0", 0)]
    empty = hashlib.sha256(b"").hexdigest()
    rows += [("r4", empty, None, None), (None, empty, None, None), ("r5", "c0", "s0", 0), ("r5", "c0", "s0", 0)]
    frame = spark.createDataFrame(rows, columns)
    texts = spark.createDataFrame([(f"c{k}", f"text {k}") for k in range(10)], "CommentId string, SurveyComment string")
    order = ["FeedbackId", "CommentId", "Segment", "SegmentNumber", "SurveyComment"]
    want, got = report.attach_text(frame, texts).select(*order), report.attach_text_dealt(frame, texts, 4).select(*order)
    assert got.count() == len(rows) and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = persist_bucketed(frame.repartition(8, "FeedbackId"), "owned", "FeedbackId", 8)
        dealt = report.attach_text_dealt(stored, texts, 4).filter("FeedbackId IS NOT NULL")
        lines = dealt._jdf.queryExecution().executedPlan().toString().splitlines()
        named = next(k for k, line in enumerate(lines) if "Exchange hashpartitioning(FeedbackId" in line)
        assert "Segment#" in lines[named + 2] and "SurveyComment" not in lines[named + 1] + lines[named + 2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
