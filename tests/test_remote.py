"""Pages as partitions, batches written once however often a task is tried."""

import json
import os
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.session import shared_dir
from earshot.sources import remote

cloudpickle.register_pickle_by_value(sys.modules[__name__])
SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])


class Numbers:
    """Rows 0 to ``total``; keeps a log of fetches in a shared folder."""

    schema = SCHEMA

    def __init__(self, total, log):
        self.total, self.log = total, log

    def fetch(self, offset, size, where):
        rows = [(str(i), i % 7) for i in range(self.total)]
        names = [f.name for f in SCHEMA.fields]
        rows = [r for r in rows if all(r[names.index(c)] == v for c, v in where.items())]
        with open(f"{self.log}/{uuid.uuid4().hex}", "w") as f:
            json.dump([offset, size, sorted(where)], f)
        return rows[offset : offset + size]


class Keyed:
    """A keyed store of files; every third key kills its task once, after the change and before the ledger."""

    schema = SCHEMA

    def __init__(self, root, dies):
        self.root, self.dies = root, dies

    def apply(self, key, rows):
        place = f"{self.root}/{key.replace('/', '_')}"
        if os.path.exists(place):  # applied before: the same answer
            return json.load(open(place))
        changed = sum(r["n"] % 2 == 0 for r in rows)
        json.dump(changed, open(place, "w"))
        with open(f"{self.root}/applied.log", "a") as f:
            f.write(f"{len(rows)}\n")
        if self.dies and int(key.rsplit("/", 1)[1]) % 3 == 0:
            raise RuntimeError("lost on the way back")
        return changed


@pytest.fixture
def folder(spark):
    def make():
        path = f"{shared_dir(spark).removeprefix('file://')}/remote-{uuid.uuid4().hex}"
        os.makedirs(path)
        return path

    return make


def fetches(log):
    return [json.load(open(f"{log}/{f}")) for f in os.listdir(log)]


@pytest.mark.parametrize("total", [0, 1, 10, 11, 95, 1000])
def test_all_pages_in_one_job(spark, folder, total):
    log = folder()
    remote.register(spark, "numbers", Numbers(total, log))
    got = spark.read.format("numbers").option("pageSize", 10).load().collect()
    assert sorted(map(tuple, got)) == sorted((str(i), i % 7) for i in range(total))
    whole = [f for f in fetches(log) if f[1] == 10]
    assert len(whole) == -(-total // 10) and len(fetches(log)) - len(whole) <= 24
    assert len({f[0] for f in whole}) == len(whole)


def test_offset_limit_and_conditions_reach_the_store(spark, folder):
    log = folder()
    remote.register(spark, "numbers", Numbers(500, log))
    read = spark.read.format("numbers").option("pageSize", 10)
    got = [r.k for r in read.option("offset", 95).option("limit", 25).load().collect()]
    assert sorted(map(int, got)) == list(range(95, 120))
    log = folder()
    remote.register(spark, "numbers_too", Numbers(500, log))
    some = spark.read.format("numbers_too").option("pageSize", 10).load().filter("n = 3").select("k").collect()
    assert sorted(int(r.k) for r in some) == list(range(3, 500, 7))
    assert all(f[2] == ["n"] for f in fetches(log))


@pytest.mark.parametrize("pages", [0, 1, 2, 3, 7, 8, 9, 100])
def test_page_count(pages):
    asked = []
    assert remote.page_count(lambda at: asked.append(at) or at < pages * 5 - 2, 5) == pages if pages else remote.page_count(lambda at: 0, 5) == 0
    assert len(asked) <= 16


def test_batches_are_applied_once(spark, folder):
    rows = spark.range(0, 1234, 1, 5).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10).cast("int").alias("n"))
    store, ledger = folder(), folder()
    remote.register(spark, "keyed", Keyed(store, dies=False))
    first = remote.write_batches(rows, "keyed", ledger, "day1", 100)
    assert first == {"Batches": 13, "Rows": 1234, "Affected": sum(i % 10 % 2 == 0 for i in range(1234))}
    # the same run again, dealt differently: nothing reaches the store
    assert remote.write_batches(rows.repartition(3), "keyed", ledger, "day1", 100) == first
    assert sum(int(n) for n in open(f"{store}/applied.log")) == 1234


def test_a_task_that_dies_changes_nothing_twice(spark, folder):
    """Tasks die after the store's change; the job is repeated until none dies, as retries would."""
    rows = spark.range(0, 900, 1, 4).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10).cast("int").alias("n"))
    store, ledger = folder(), folder()
    remote.register(spark, "dying", Keyed(store, dies=True))
    tries = 0
    while True:
        tries += 1
        assert tries < 12
        try:
            got = remote.write_batches(rows, "dying", ledger, "day1", 100)
            break
        except Exception as e:
            assert "lost on the way back" in str(e)
    assert tries > 1 and got == {"Batches": 9, "Rows": 900, "Affected": 450}
    assert sum(int(n) for n in open(f"{store}/applied.log")) == 900
