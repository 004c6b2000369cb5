"""A remote keyed store as a Spark data source: pages are read as partitions, batches are written once.

``register(spark, name, store)`` makes ``spark.read.format(name)`` and ``df.write.format(name)`` work for a store, which is any
picklable object with the methods of :class:`Store`. Reading takes one job for all pages: how many there are is found by
doubling and bisecting on pages that may be empty, so no page is fetched twice over and nothing is numbered. Conditions on columns are
handed to the store, and ``offset`` and ``limit`` options narrow the pages. Writing hands rows over in numbered batches. Every batch has
a key made of the run and its number; a ledger in a shared folder holds what each key changed, so a task that is tried again
skips what is in the ledger, and totals count each batch once. The store gets the key too, for the case that a task dies
between the store's change and the ledger's entry.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, InputPartition, WriterCommitMessage

from earshot.operators.skew import numbered

# The task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: rows per page and per batch.
PAGE_SIZE = 1000
PAGES_PER_TASK = 16
BATCH = "Batch"


class Store(Protocol):
    schema: T.StructType

    def fetch(self, offset: int, size: int, where: dict[str, object]) -> Sequence[tuple]:
        """Rows ``offset`` to ``offset + size`` of those with the given values; fewer at the end, none beyond."""

    def apply(self, key: str, rows: list[dict]) -> int:
        """Apply a batch and tell how many rows it changed; a key that was applied changes nothing and tells the same."""


def page_count(fetch: Callable[[int], int], size: int) -> int:
    """Pages that are not empty, from a fetch of one row at a page's start: logarithmic in their number."""
    if not fetch(0):
        return 0
    full, empty = 0, 1
    while fetch(empty * size):
        full, empty = empty, 2 * empty
    while empty - full > 1:
        middle = (full + empty) // 2
        full, empty = (middle, empty) if fetch(middle * size) else (full, middle)
    return full + 1


@dataclass
class Pages(InputPartition):
    first: int
    last: int


class PageReader(DataSourceReader):
    def __init__(self, store: Store, options: dict[str, str]):
        self.store = store
        self.size = int(options.get("pagesize", PAGE_SIZE))
        self.offset = int(options.get("offset", 0))
        self.limit = int(options["limit"]) if "limit" in options else None
        self.where: dict[str, object] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            if isinstance(one, EqualTo) and len(one.attribute) == 1 and one.attribute[0] not in self.where:
                self.where[one.attribute[0]] = one.value
            else:
                yield one

    def partitions(self) -> list[InputPartition]:
        pages = page_count(lambda at: len(self.store.fetch(self.offset + at, 1, self.where)), self.size)
        if self.limit is not None:
            pages = min(pages, -(-self.limit // self.size))
        return [Pages(k, min(k + PAGES_PER_TASK, pages)) for k in range(0, pages, PAGES_PER_TASK)] or [Pages(0, 0)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        for page in range(partition.first, partition.last):
            start = page * self.size
            size = self.size if self.limit is None else min(self.size, self.limit - start)
            yield from self.store.fetch(self.offset + start, size, self.where)


@dataclass
class Sent(WriterCommitMessage):
    batches: dict[int, tuple[int, int]]


class Ledger:
    """What each batch of a run changed, as a small file per batch in a shared folder."""

    def __init__(self, root: str, run: str):
        self.root, self.run = root.rstrip("/"), run

    def _place(self):
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("file:") else (fs.LocalFileSystem(), self.root)
        return system, f"{path}/{self.run}"

    def entry(self, batch: int) -> tuple[int, int] | None:
        system, path = self._place()
        found = system.get_file_info(f"{path}/{batch}.json")
        if not found.is_file:
            return None
        with system.open_input_stream(found.path) as f:
            return tuple(json.loads(f.read()))

    def note(self, batch: int, rows: int, affected: int) -> None:
        """Written beside and moved into place, so that an entry is whole or not there."""
        system, path = self._place()
        system.create_dir(path, recursive=True)
        aside = f"{path}/_{batch}-{id(self)}.tmp"
        with system.open_output_stream(aside) as f:
            f.write(json.dumps([rows, affected]).encode())
        system.move(aside, f"{path}/{batch}.json")

    def close(self, totals: dict[str, int]) -> None:
        system, path = self._place()
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/_totals.json") as f:
            f.write(json.dumps(totals).encode())

    def totals(self) -> dict[str, int]:
        """Batches, rows and affected rows of a run that was committed."""
        system, path = self._place()
        with system.open_input_stream(f"{path}/_totals.json") as f:
            return json.loads(f.read())


class BatchWriter(DataSourceWriter):
    def __init__(self, store: Store, options: dict[str, str]):
        self.store = store
        self.ledger = Ledger(options["ledger"], options["run"])

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        """Rows come in the order of their batches, each batch whole in one task."""
        done: dict[int, tuple[int, int]] = {}
        waiting: list[dict] = []
        current = None

        def hand_over() -> None:
            if not waiting:
                return
            entry = self.ledger.entry(current)
            if entry is None:
                entry = (len(waiting), int(self.store.apply(f"{self.ledger.run}/{current}", list(waiting))))
                self.ledger.note(current, *entry)
            done[current] = entry
            waiting.clear()

        for row in iterator:
            values = row.asDict()
            batch = values.pop(BATCH)
            if batch != current:
                hand_over()
                current = batch
            waiting.append(values)
        hand_over()
        return Sent(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        batches: dict[int, tuple[int, int]] = {}
        for m in messages:
            batches |= m.batches if m else {}
        self.ledger.close({"Batches": len(batches), "Rows": sum(r for r, _ in batches.values()), "Affected": sum(a for _, a in batches.values())})


def register(spark: SparkSession, name: str, store: Store) -> None:
    """Make a store readable and writable under ``name``; conditions are handed down where the session allows it."""

    class Remote(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return store.schema

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return PageReader(store, self.options)

        def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
            return BatchWriter(store, self.options)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Remote)


def write_batches(df: DataFrame, name: str, ledger: str, run: str, batch_size: int = PAGE_SIZE) -> dict[str, int]:
    """Hand all rows to a registered store in batches and return the totals; the same run again changes nothing.

    Rows are numbered in an order of their own, so a row is in the same batch whenever and wherever a task is tried.
    """
    rows = numbered(df).withColumn(BATCH, F.floor((F.col("RowNumber") - 1) / F.lit(batch_size)).cast("long"))
    dealt = rows.drop("RowNumber").repartition(BATCH).sortWithinPartitions(BATCH)
    dealt.write.format(name).mode("append").option("ledger", ledger).option("run", run).save()
    return Ledger(ledger, run).totals()
