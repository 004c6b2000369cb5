"""The completion stage in a pipeline, mergeable counts, and rejected labels."""

import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from earshot.operators import labels, quality
from earshot.operators.transformer import CompletionTransformer, message_key
from earshot.schemas import COMPLETIONS
from earshot.session import scratch_path

MESSAGE = "array<struct<role: string, content: string, name: string>>"


def test_stage_is_saved_loaded_and_run(spark):
    say = lambda t: [("system", "s", "system"), ("user", t, "user")]
    rows = [(1, say("a"), "x"), (2, say("b"), "y"), (2, say("b"), "y"), (3, say("c"), None), (4, None, "z"), (5, say("d"), "w")]
    asked = spark.createDataFrame(rows, f"id int, Ask {MESSAGE}, Failure string")
    keys = {r.id: r.k for r in asked.select("id", message_key(F.col("Ask")).alias("k")).collect()}
    stored = [
        (keys[1], ["A"], ["stop"], None, "i1", 1), (keys[1], None, None, ("429", "busy"), "i2", 9),  # the usable one counts
        (keys[2], None, None, ("429", "busy"), "i3", 2), (keys[3], ["C"], ["stop"], None, "i4", 3), (keys[3], ["C2"], ["stop"], None, "i5", 4),
    ]
    folder = scratch_path(spark, "completions")
    spark.createDataFrame(stored, COMPLETIONS).write.parquet(folder)
    stage = CompletionTransformer().setMessagesCol("Ask").setOutputCol("Answer").setErrorCol("Failure").setCompletionsPath(folder)
    place = scratch_path(spark, "model")
    Pipeline(stages=[stage]).fit(asked).write().save(place)
    out = PipelineModel.load(place).transform(asked)
    assert out.columns == ["id", "Ask", "Answer", "Failure"]  # the error column takes the place of one of its name
    got = sorted((r.id, r.Answer.content[0] if r.Answer and r.Answer.content else None, r.Failure.code if r.Failure else None) for r in out.collect())
    assert sorted(map(repr, got)) == sorted(map(repr, [(1, "A", None), (2, None, "429"), (2, None, "429"), (3, "C2", None), (4, None, None), (5, None, None)]))
    only = CompletionTransformer(messagesCol="Ask", completionsPath=folder).transform(asked.select("Ask"))
    assert only.columns == ["Ask", "Completion", "Error"] and only.count() == 6


def report_rows(spark, seed, n):
    rng = random.Random(seed)
    pick = lambda *v: rng.choice(v)
    rows = [(str(rng.randrange(n // 2)), 20240101 + rng.randrange(3), pick("Up", "Down", None), pick("W1", None), "S", pick("P", "Q")) for _ in range(n)]
    return spark.createDataFrame(rows, "FeedbackId string, DIM_DateId int, SentimentLabel string, WorkloadLabel string, SupportLabel string, PlatformLabel string")


def test_days_are_added_to_bitmaps(spark):
    one, two = report_rows(spark, 1, 900), report_rows(spark, 2, 700)
    none = spark.createDataFrame([], "FeedbackId string, Number long")
    first = quality.number_responses(one, none)
    second = quality.number_responses(two, first)
    numbers = {r.FeedbackId: r.Number for r in second.collect()}
    assert {r.FeedbackId: r.Number for r in first.collect()}.items() <= numbers.items()
    assert sorted(numbers.values()) == list(range(1, len(numbers) + 1))
    kept = quality.label_bitmaps(one, first)
    both = kept.unionByName(quality.label_bitmaps(two, second))
    for bitmaps, rows in ((kept, one), (both, one.unionByName(two)), (both.filter("DIM_DateId = 20240102"), one.unionByName(two).filter("DIM_DateId = 20240102"))):
        got = quality.merged_label_counts(bitmaps, 7).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, quality.label_counts(rows, 7).collect()))
    assert quality.merged_label_counts(both.limit(0), 7).count() == 0


def test_bitmaps_span_buckets(spark):
    numbers = spark.range(1, 70_001).select(F.col("id").cast("string").alias("FeedbackId"), F.col("id").alias("Number"))
    rows = numbers.select("FeedbackId", F.lit(1).alias("DIM_DateId"), *[F.lit("X").alias(c) for c in ("SentimentLabel", "WorkloadLabel", "SupportLabel", "PlatformLabel")])
    bitmaps = quality.label_bitmaps(rows, numbers)
    assert bitmaps.count() == 4 * 3
    assert {r.DistinctResponseCount for r in quality.merged_label_counts(bitmaps, 1).collect()} == {70_000}


def test_rejects_are_what_snapping_turns_to_null(spark):
    rows = [("c", i, a, b, "Yes", "Web") for i, (a, b) in enumerate([("Positive", "zzzz qqqq"), ("possitive", None), ("##", "Planting"), (None, "Plantng"), ("##", "x")])]
    frame = spark.createDataFrame(rows, "CommentId string, SegmentNumber long, SentimentLabel string, WorkloadLabel string, SupportLabel string, PlatformLabel string")
    for floor in (0.0, 0.5, 0.9):
        out = labels.rejected_labels(frame, floor)
        got = {(r.SegmentNumber, r.LabelType): (r.RawLabel, r.Score) for r in out.collect()}
        snapped = {r.SegmentNumber: r for r in labels.snap_to_vocabulary(frame, floor=floor).collect()}
        want = {(r[1], t) for r in rows for t, raw in zip(labels.LABEL_TYPES, r[2:]) if raw is not None and snapped[r[1]][f"{t}Label"] is None}
        assert set(got) == want and all(s < floor for _, s in got.values())
        assert all(got[k][0] == rows[k[0]][2 + labels.LABEL_TYPES.index(k[1])] for k in got)
    assert len(want) >= 3
