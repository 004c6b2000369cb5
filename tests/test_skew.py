"""Hot keys: spread joins, replication and numbering give the plain results."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from earshot.operators import comments, quality, report
from earshot.operators.skew import hot_keys, is_small, lookup_join, numbered, repeat_rows, skew_join


@pytest.fixture(scope="module")
def many(spark):
    # A third of the rows on one key, null keys, and keys without a partner.
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{i % 40}") for i in range(3000)]
    return spark.createDataFrame(rows, "id int, k string")


@pytest.fixture(scope="module")
def one(spark):
    return spark.createDataFrame([("hot", "H")] + [(f"k{i}", str(i)) for i in range(20)], "k string, v string")


def test_hot_keys_are_few_and_cut_by_size(many):
    hot = hot_keys(many, ["k"], share=0.05, min_rows=10).collect()
    assert {r["k"]: r["_pieces"] for r in hot}["hot"] == 7 and len(hot) <= 20
    assert hot_keys(many, ["k"]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(many, one, how):
    hot = hot_keys(many, ["k"], share=0.02, min_rows=10)
    spread = skew_join(many, one, ["k"], how, ["id"], hot)
    assert Counter(map(tuple, spread.select(sorted(spread.columns)).collect())) == Counter(
        map(tuple, many.join(one, ["k"], how).select(sorted(spread.columns)).collect())
    )


def test_spread_join_really_spreads(many, one):
    hot = hot_keys(many, ["k"], share=0.02, min_rows=10)
    plan = skew_join(many, one, ["k"], "inner", ["id"], hot)._jdf.queryExecution().toString()
    assert "_piece" in plan
    pieces = many.join(hot, "k").select("k", F.pmod(F.xxhash64("id"), F.col("_pieces")).alias("p"))
    sizes = [r["count"] for r in pieces.filter("k = 'hot'").groupBy("p").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 150


def test_counts_table_gives_the_same_hot_keys(many):
    counts = many.groupBy("k").count()
    direct = hot_keys(many, ["k"], share=0.05, min_rows=10).collect()
    assert sorted(map(tuple, hot_keys(counts, ["k"], 0.05, 10, weight="count").collect())) == sorted(map(tuple, direct))


def test_lookup_is_broadcast_only_when_small(many, one):
    assert is_small(one, 100) and not is_small(one, 5) and not is_small(one, 100, max_bytes=50)
    small = lookup_join(many, one, ["k"], "left")
    large = lookup_join(many, one, ["k"], "left", max_rows=5)
    assert "ResolvedHint (strategy=broadcast)" in small._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in large._jdf.queryExecution().analyzed().toString()
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect()))


def test_repeat_rows_in_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 10), ("c", 25)], "x string, n long")
    got = Counter((r["x"]) for r in repeat_rows(df, "n", per_row=4).collect())
    assert got == {"a": 1, "b": 10, "c": 25}
    copies = sorted(r["_copy"] for r in repeat_rows(df, "n", per_row=4).filter("x = 'c'").collect())
    assert copies == list(range(25))


def test_numbering_is_dense_and_repeatable(many):
    rows = many.select("k")
    first = sorted(map(tuple, numbered(rows).collect()), key=lambda r: r[1])
    assert [r[1] for r in first] == list(range(1, 3001))
    again = sorted(map(tuple, numbered(rows.repartition(13)).collect()), key=lambda r: r[1])
    assert first == again


def test_bags(spark):
    a = spark.createDataFrame([(1, None)] * 5 + [(2, "x")] * 3 + [(3, "y")], "n int, s string")
    b = spark.createDataFrame([(1, None)] * 2 + [(2, "x")] * 4, "n int, s string")
    bag = lambda df: Counter(map(tuple, df.collect()))
    assert bag(quality.find_duplicates(a)) == {(1, None): 4, (2, "x"): 2}
    assert bag(quality.except_all(a, b)) == bag(a.exceptAll(b))
    assert quality.frames_equal(a, b).head().asDict() == {"OnlyLeft": 4, "OnlyRight": 1, "Equal": False}
    assert quality.frames_equal(a, a.repartition(3)).head()["Equal"]
    assert not quality.frames_equal(a, a.withColumn("n", F.col("n").cast("long"))).head()["Equal"]


def test_hot_comment_through_the_report(spark):
    """Half of all responses share one comment; spreading must not change any report row."""
    fact = spark.createDataFrame(
        [(20240101, 10, str(i), "hot" if i % 2 else f"c{i % 20}", "text", i % 11) for i in range(400)],
        "DIM_DateId int, DIM_ProductMasterId int, FeedbackId string, CommentId string, SurveyComment string, Score int",
    )
    dim = spark.createDataFrame(
        [("NPS", "hot", 200, 20240101)] + [("NPS", f"c{i}", 20, 20240101 if i % 4 else None) for i in range(0, 20, 2)],
        "SurveyType string, CommentId string, ResponseCount long, ProcessingDate int",
    )
    labelled = spark.createDataFrame(
        [(c, n, f"seg{n}", 0.5, 0.5, "P", "W", "S", "L") for c in ["hot", *[f"c{i}" for i in range(20)]] for n in (0, 1)],
        "CommentId string, SegmentNumber long, Segment string, Coverage double, CumulativeCoverage double,"
        " SentimentLabel string, WorkloadLabel string, SupportLabel string, PlatformLabel string",
    )
    hot = comments.hot_comments(dim, share=0.05, min_rows=10)
    assert {r["CommentId"] for r in hot.collect()} == {"hot"}
    bag = lambda df: Counter(map(tuple, df.collect()))
    plain = report.current_report(report.processed_fact(fact, dim), labelled)
    spread = report.current_report(report.processed_fact(fact, dim, hot), labelled, hot)
    assert bag(plain) == bag(spread) and sum(bag(plain).values()) == 2 * (200 + 100)
    total = plain.filter(F.col("FeedbackId").cast("int") < 300)
    repeats = report.unreported_repeats(report.processed_fact(fact, dim), total)
    assert bag(report.inherit_labels(repeats, total)) == bag(report.inherit_labels(repeats, total, hot=hot))
    assert report.inherit_labels(repeats, total, mode="single").count() == repeats.count()


def test_responses_of_a_known_duplicate_do_not_multiply(spark):
    from earshot.operators.shape import typed_backfill
    from earshot.schemas import REPORT

    total = typed_backfill(
        spark.createDataFrame([(str(i), "known", "s", 0) for i in range(50)], "FeedbackId string, CommentId string, Segment string, SegmentNumber long"),
        REPORT, {"ReportingType": "Report"},
    )
    fact = spark.createDataFrame([(20240101, 10, "d1", "dup", "t", 1)], "DIM_DateId int, DIM_ProductMasterId int, FeedbackId string, CommentId string, SurveyComment string, Score int")
    pairs = spark.createDataFrame([("dup", "known", None)], "CommentId string, KnownCommentId string, ReportingDate int")
    assert report.fan_out_duplicates(pairs, total, fact).count() == 1
