"""Table store, paging, change sets, batches, retention."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.operators import quality, shape
from earshot.operators.report import drop_removed_feedback
from earshot.session import scratch_path, shared_dir
from earshot.sources import paging, retention
from earshot.sources.tables import TableStore

PAIR = T.StructType().add("k", "string").add("v", "integer")


def store(spark):
    return TableStore(spark, scratch_path(spark, "test"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_replace_a_table_that_is_being_read(spark):
    s = store(spark)
    assert not s.exists("t") and s.read_or_empty("t", PAIR).schema == PAIR
    s.overwrite("t", spark.createDataFrame([("a", 1)], PAIR))
    for n in range(2, 5):
        grown = s.read("t").unionByName(spark.createDataFrame([("a", n)], PAIR))
        s.overwrite("t", grown)
    assert rows(s.read("t")) == [("a", n) for n in range(1, 5)]
    assert len(s._finished("t")) == 2


def test_half_written_version_is_not_the_table(spark):
    s = store(spark)
    s.overwrite("t", spark.createDataFrame([("a", 1)], PAIR))
    spark.createDataFrame([("b", 2)], PAIR).write.parquet(s._version("t", 2))
    s._remove(s._version("t", 2) + "/_SUCCESS")
    assert rows(s.read("t")) == [("a", 1)]
    s.overwrite("t", spark.createDataFrame([("c", 3)], PAIR))
    assert rows(s.read("t")) == [("c", 3)]


def test_partitions_are_replaced_alone_and_may_become_empty(spark):
    s = store(spark)
    day = lambda k, d: spark.createDataFrame([(k, d)], PAIR)
    s.overwrite_partition("p", day("a", 1), {"v": 1})
    s.overwrite_partition("p", day("b", 2), {"v": 2})
    s.overwrite_partition("p", day("c", 2), {"v": 2})
    assert rows(s.read("p", PAIR)) == [("a", 1), ("c", 2)]
    s.overwrite_partition("p", day("c", 2).limit(0), {"v": 2})
    assert rows(s.read("p", PAIR)) == [("a", 1)]
    plan = s.read_partition("p", PAIR, {"v": 1})._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(v" in plan


def test_pages_end(spark):
    paged = paging.with_pages(spark.range(25).select(F.col("id").cast("string").alias("k")), 10)
    sizes = [paging.read_page(paged, o, 10).count() for o in (0, 10, 20, 30)]
    assert sizes == [10, 10, 5, 0]


def test_a_stored_page_opens_its_own_files(spark):
    paged = paging.store_pages(spark.range(0, 95, 1, 4).select(F.col("id").cast("string").alias("k")), 10)
    pages = list(paging.each_page(paged, 10))
    assert [p.count() for p in pages] == [10] * 9 + [5]
    files = [{r[0] for r in p.select(F.input_file_name()).distinct().collect()} for p in pages]
    assert all("Page=%d/" % i in f for i, fs in enumerate(files) for f in fs)
    assert all("PartitionFilters: [isnotnull(Page" in p._jdf.queryExecution().toString() for p in pages)
    other = list(paging.each_page(paged, 7))
    assert [sorted(r["RowNumber"] for r in p.collect()) for p in other] == [list(range(o + 1, min(o + 8, 96))) for o in range(0, 95, 7)]
    assert list(paging.each_page(paging.store_pages(spark.createDataFrame([], "k string")))) == []


def test_change_set_round_trip_with_null_keys(spark):
    schema = "f string, n long, d int"
    before = spark.createDataFrame([("1", 0, 5), ("2", None, 5), ("3", 0, 5)], schema)
    after = spark.createDataFrame([("2", None, 6), ("3", 0, 5), ("4", 1, 5)], schema)
    changes = paging.change_set(before, after, ["f", "n"])
    assert {r["f"]: r["Action"] for r in changes.collect()} == {"1": "delete", "2": "update", "4": "insert"}
    assert rows(paging.apply_changes(before, changes, ["f", "n"])) == rows(after)
    # The same changes again find nothing to do.
    done = paging.affected_rows(after, changes, ["f", "n"]).collect()
    assert {r["Action"]: r["Affected"] for r in done} == {"insert": 0, "delete": 0, "update": 1}
    assert rows(paging.apply_changes(after, changes, ["f", "n"])) == rows(after)


def test_batches_are_sent_whole(spark):
    df = spark.range(0, 2500, 1, 2).select(F.col("id").cast("string").alias("k"))
    got = paging.send_batches(df, len).head()
    assert (got["Rows"], got["Affected"]) == (2500, 2500) and got["Batches"] >= 4


def test_retention_takes_tables_of_the_exact_age(spark):
    names = ["a_buffer_20240107_x", "a_buffer_20240108_x", "a_buffer_x", "a_20240101", "a_buffer_20249999_x", "a_buffer_120240101"]
    listing = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r["name"] for r in retention.expired_tables(listing, 20240110, 3).collect()] == ["a_buffer_20240107_x"]
    s = store(spark)
    for n in names[:2]:
        s.overwrite(n, listing)
    assert retention.drop_expired(s, retention.expired_tables(s.listing(), 20240110, 3)) == names[:1]
    assert rows(s.listing()) == [(names[1],)]


def test_conform_and_backfill(spark):
    df = spark.createDataFrame([("x", "7"), ("y", "seven")], "k string, v string")
    assert rows(shape.conform(df, PAIR)) == [("x", 7), ("y", None)]
    wide = shape.typed_backfill(df.select("k"), T.StructType([*PAIR.fields, T.StructField("w", T.DoubleType())]), {"v": 3})
    assert wide.dtypes == [("k", "string"), ("v", "int"), ("w", "double")]


def test_unmapped_label_becomes_null(spark):
    df = spark.createDataFrame([("a",), ("z",)], "l string")
    assert rows(shape.rename_labels(df, "l", {"a": "b"})) == [("b",), (None,)]
    table = spark.createDataFrame([("a", "b")], "x string, y string")
    assert rows(shape.rename_labels(df, "l", table)) == [("b",), (None,)]


def test_context_of_null_is_empty(spark):
    df = spark.createDataFrame([("1", None), ("2", "a,b")], "FeedbackId string, Value string")
    assert rows(shape.context_normalise(df)) == [("1", ""), ("2", "a,b")]


def qc(spark, *counts):
    return spark.createDataFrame([(1, "SentimentLabel", l, n) for l, n in counts], "DIM_DateId int, LabelType string, LabelValue string, DistinctResponseCount long")


def test_drift(spark):
    prior = qc(spark, ("Up", 1), ("Down", 5), ("Gone", 2), ("Not Labeled", 3))
    now = qc(spark, ("Up", 2), ("Down", 4), ("New", 1), ("Not Labeled", 4))
    got = {r["LabelValue"]: (r["DIM_DateId"], r["DistinctResponseCount"], r["IssueFlag"]) for r in quality.label_drift(prior, now, 2).collect()}
    assert got == {"Up": (2, 2, False), "Down": (2, 4, True), "Gone": (2, 0, True), "New": (2, 1, False), "Not Labeled": (2, 4, True)}
    full = quality.append_qc(prior.withColumns({"IssueFlag": F.lit(False), "SurveyType": F.lit("NPS")}), quality.label_drift(prior, now, 2), "NPS")
    alerts = quality.drift_alerts(full, 2).collect()
    assert sorted((r["DIM_DateId"], r["LabelValue"]) for r in alerts) == [
        (1, "Down"), (1, "Gone"), (1, "Not Labeled"), (2, "Down"), (2, "Gone"), (2, "Not Labeled")
    ]
    dim = spark.createDataFrame([(2,), (None,)], "ProcessingDate int")
    assert not any(r["IssueFlag"] for r in quality.silence_backfill(quality.label_drift(prior, now, 2), dim, 2).collect())


def test_label_counts_take_null_as_not_labeled(spark):
    df = spark.createDataFrame([("1", None, "W", "S", "P"), ("1", "A", "W", "S", "P"), ("2", None, "W", "S", "P")], "FeedbackId string, SentimentLabel string, WorkloadLabel string, SupportLabel string, PlatformLabel string")
    got = {(r["LabelType"], r["LabelValue"]): r["DistinctResponseCount"] for r in quality.label_counts(df, 1).collect()}
    assert got == {("SentimentLabel", "Not Labeled"): 2, ("SentimentLabel", "A"): 1, ("WorkloadLabel", "W"): 2, ("SupportLabel", "S"): 2, ("PlatformLabel", "P"): 2}


def test_metrics_while_writing(spark):
    df, seen = quality.observed(spark.range(7), {"rows": F.count(F.lit(1))})
    store(spark).overwrite("t", df)
    assert seen.get == {"rows": 7}


def test_removed_feedback(spark):
    rep = spark.createDataFrame([("1", 0), ("1", 1), ("2", 0)], "FeedbackId string, SegmentNumber int")
    assert rows(drop_removed_feedback(rep, spark.createDataFrame([("1",)], "FeedbackId string"))) == [("1", 0), ("1", 1)]
