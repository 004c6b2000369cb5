"""Intake of changed partitions against a full one, and the dictionary filter."""

import random

import pytest
from pyspark.sql import functions as F

from checks.rules import rule_answer
from earshot.functions.text import lower_tokens
from earshot.operators import comments, intake
from earshot.plans import daily
from earshot.plans.daily import Run, comment_dim
from earshot.schemas import COMMENT_COUNTS, FACT_SURVEY
from earshot.session import scratch_path
from earshot.sources.fact_files import FactFiles
from earshot.sources.tables import TableStore

WORDS = ["reports", "slow", "price", "help", "theme"]


def say(rng):
    return " ".join(rng.choice([*WORDS, "xq", "zz9"]) for _ in range(rng.randint(1, 3)))


def rows_of(seed, n=300):
    rng = random.Random(seed)
    rows = [(str(i), rng.choice([say(rng), say(rng), None, "", "?", "xq zz9"]), rng.choice(["NPS", "NPS", "CSAT"]), "False", rng.choice([10, 99]), 20240101 + i % 20, i % 10) for i in range(n)]
    return rows


def dims(store, run):
    dim = comment_dim(store, run).select("CommentId", "SurveyComment", "FirstResponseDate", "LastResponseDate", "ResponseCount", "CharacterCount")
    silent = store.read(run.table("nonresponse_dim")).select("CommentId", "SurveyComment", "ResponseCount")
    texts = daily._texts(store, run)
    return [sorted(map(tuple, d.collect())) for d in (dim, silent, texts)]


@pytest.mark.parametrize("files", [False, True])
def test_changed_partitions_give_the_full_result(spark, files):
    words = spark.createDataFrame([(w,) for w in WORDS], "word string")
    run = lambda day: Run("NPS", day, 20230101, rule_answer, products=[10])
    store = TableStore(spark, scratch_path(spark, "intake"))
    place = scratch_path(spark, "fact")
    rng = random.Random(5)
    rows = rows_of(1)
    days = [20240110, 20240111, 20240112, 20240113]
    for step, day in enumerate(days):
        if files and step > 1:
            break
        if step == 1:  # withdrawn, edited and new responses on two days; one day goes altogether
            rows = [r for r in rows if r[5] not in (20240103,)]
            rows = [r for r in rows if not (r[5] == 20240105 and int(r[0]) % 3 == 0)]
            rows = [(*r[:1], say(rng), *r[2:]) if r[5] == 20240107 and int(r[0]) % 2 else r for r in rows]
            rows += [(str(1000 + i), say(rng), "NPS", "False", 10, 20240121, 1) for i in range(30)]
        if step == 3:
            rows = []
        frame = spark.createDataFrame(rows, FACT_SURVEY)
        if files:
            old = TableStore(spark, place)
            old.overwrite_partitions("fact", frame, ["DIM_DateId"]) if rows else None
            for gone in {20240103} if step else set():
                old.drop_partition("fact", {"DIM_DateId": gone})
            fact = FactFiles(spark, old.path("fact"), FACT_SURVEY)
        else:
            fact = frame
        daily.intake(store, fact, words, run(day))
        if step in (1, 3):
            fresh = TableStore(spark, scratch_path(spark, "whole"))
            daily.intake(fresh, frame, words, run(day))
            assert dims(store, run(day)) == dims(fresh, run(day)), step
        changed = [r.Value for r in store.read(f"metrics/{day}/{run(day).table('intake')}").filter("Metric = 'changed partitions'").collect()]
        if not files:  # rewriting all folders gives every file a new time
            most = [20, 4, 0, 21][step]  # a day without an eligible response has no mark
            assert changed == [] or changed[0] <= most, (step, changed)
            assert step or changed[0] > 15


def test_only_changed_folders_are_read_and_written(spark):
    place = TableStore(spark, scratch_path(spark, "fact"))
    frame = spark.createDataFrame(rows_of(2), FACT_SURVEY)
    place.overwrite_partitions("fact", frame, ["DIM_DateId"])
    fact = FactFiles(spark, place.path("fact"), FACT_SURVEY)
    before = fact.marks()
    assert before.count() == 20
    place.overwrite_partition("fact", frame.filter("DIM_DateId = 20240104").limit(3), {"DIM_DateId": 20240104})
    changed = [r[0] for r in intake.changed_partitions(fact.marks(), before).collect()]
    assert changed == [20240104]
    plan = fact.frame().filter(F.col("DIM_DateId").isin(changed))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DIM_DateId" in plan and "20240104" in plan  # other folders are not opened
    # texts: files of the first day stay; the second day adds its own
    words = spark.createDataFrame([(w,) for w in WORDS], "word string")
    store = TableStore(spark, scratch_path(spark, "texts"))
    run = lambda day: Run("NPS", day, 20230101, rule_answer, products=[10])
    daily.intake(store, frame, words, run(20240110))
    first = set(daily._texts(store, run(1)).inputFiles())
    more = frame.unionByName(spark.createDataFrame([("x", "a new help text", "NPS", "False", 10, 20240105, 1)], FACT_SURVEY))
    daily.intake(store, more, words, run(20240111))
    second = set(daily._texts(store, run(1)).inputFiles())
    assert first < second and len(second - first) == 1


def test_a_run_that_died_is_made_good(spark, monkeypatch):
    words = spark.createDataFrame([(w,) for w in WORDS], "word string")
    run = Run("NPS", 20240110, 20230101, rule_answer, products=[10])
    store = TableStore(spark, scratch_path(spark, "died"))
    frame = spark.createDataFrame(rows_of(3), FACT_SURVEY)
    daily.intake(store, frame, words, run)
    less = frame.filter("CAST(FeedbackId AS INT) % 4 <> 0")

    def die(*args):
        raise RuntimeError("executor lost")

    for step in ("_remove_texts", "_replace_counts", "_keep"):
        monkeypatch.setattr(daily, step, die)
        with pytest.raises(RuntimeError):
            daily.intake(store, less, words, run)
        monkeypatch.undo()
        if step == "_keep":
            break
    daily.intake(store, less, words, run)
    fresh = TableStore(spark, scratch_path(spark, "whole"))
    daily.intake(fresh, less, words, run)
    assert dims(store, run) == dims(fresh, run)


def test_filter_finds_every_word_and_few_others(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(3000)})
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    slots = comments.word_slots(frame)
    assert len(slots) == 1 << 15
    others = [f"{w}x" for w in words]
    texts = spark.createDataFrame([("in", " ".join(words)), ("out", " ".join(others))], "k string, t string")
    got = {r.k: r.n for r in texts.select("k", F.size(comments.likely_words(F.col("t"), slots)).alias("n")).collect()}
    assert got["in"] == len(words) and got["out"] < 0.05 * len(others)
    assert len(comments.word_slots(frame, 16, 64)) == 64  # never more than the bound


@pytest.mark.parametrize("most", [64, 1 << 23])
def test_split_is_exact_however_small_the_filter(spark, monkeypatch, most):
    monkeypatch.setattr(comments, "MOST_SLOTS", most)
    monkeypatch.setattr(comments.word_slots, "__defaults__", (16, most))
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(300)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 6))) for _ in range(400)] + ["", "a", "!!", None]
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "CommentId string, SurveyComment string")
    known = set(vocabulary[:40])
    got = {r.CommentId: r.IsNonresponse for r in comments.nonresponse_split(frame, spark.createDataFrame([(w,) for w in known], "w string")).collect()}
    want = {str(i): not t or len(t) < 2 or not known & set(t.split()) for i, t in enumerate(texts)}
    assert {k: bool(v) if v is not None else True for k, v in got.items()} == want


def test_one_token_per_comment_travels(spark):
    words = spark.createDataFrame([(w,) for w in WORDS], "word string")
    rng = random.Random(9)
    frame = spark.createDataFrame([(str(i), " ".join(rng.choice(WORDS) + str(rng.randrange(90)) if rng.random() < 0.8 else rng.choice(WORDS) for _ in range(40))) for i in range(200)], "CommentId string, SurveyComment string")
    before = frame.select(F.explode(lower_tokens(F.col("SurveyComment")))).count()
    slots = comments.word_slots(words)
    first = frame.select(F.get(comments.likely_words(F.col("SurveyComment"), slots), F.lit(0)).alias("w")).filter("w IS NOT NULL")
    assert first.count() * 10 < before
