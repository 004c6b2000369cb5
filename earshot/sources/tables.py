"""Tables kept as parquet under one shared root, readable while they are being replaced.

A whole table is a series of version folders; the newest one that Spark finished (it has a
``_SUCCESS`` file) is the table. A run that dies half-way therefore leaves the old version in
place, and a job may read a table and replace it in the same plan. A table may be kept in buckets of one
column; joins and aggregates by it then need no exchange of the table. Tables split by run date or
label type keep one folder per partition value and replace exactly those folders.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.session import forget_bucketed, read_bucketed, write_bucketed

_VERSION = re.compile(r"^version=(\d+)$")


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- folder access through Spark's own file system layer, so any shared store works

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _children(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def _present(self, path: str) -> bool:
        fs, where = self._fs(path)
        return fs.exists(where)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _finished(self, name: str) -> list[int]:
        found = [_VERSION.match(c) for c in self._children(self.path(name))]
        numbers = [int(m.group(1)) for m in found if m]
        return sorted(n for n in numbers if self._present(f"{self._version(name, n)}/_SUCCESS"))

    def _version(self, name: str, number: int) -> str:
        return f"{self.path(name)}/version={number}"

    # -- whole tables

    def exists(self, name: str) -> bool:
        return bool(self._finished(name)) or any("=" in c for c in self._children(self.path(name)))

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """Newest finished version of a table, or all partitions of a partitioned one."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        versions = self._finished(name)
        if versions:
            return reader.parquet(self._version(name, versions[-1]))
        return reader.option("basePath", self.path(name)).parquet(self.path(name))

    def read_or_empty(self, name: str, schema: T.StructType) -> DataFrame:
        """The table, or a typed empty frame when it has not been written yet."""
        if self.exists(name):
            return self.read(name, schema)
        return self.spark.createDataFrame([], schema)

    def overwrite(self, name: str, df: DataFrame, keep: int = 2) -> DataFrame:
        """Replace a whole table; readers see the old version until the new one is finished."""
        self._replace(name, df.write.parquet, keep)
        return self.read(name, df.schema)

    def overwrite_bucketed(self, name: str, df: DataFrame, by: str, buckets: int | None = None, keep: int = 2) -> DataFrame:
        """Replace a whole table by one with buckets, as many as shuffles have partitions unless told otherwise.

        Rows should be dealt out by the column already (see ``write_bucketed``).
        """
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self._replace(name, lambda path: write_bucketed(df, path, by, buckets), keep)
        return self.read_bucketed(name, df.schema)

    def read_bucketed(self, name: str, schema: T.StructType) -> DataFrame:
        """Newest version, joined by its buckets' column without an exchange; empty if there is no table yet."""
        versions = self._finished(name)
        if not versions:
            return self.read_or_empty(name, schema)
        return read_bucketed(self.spark, self._version(name, versions[-1]), schema)

    def _replace(self, name: str, write: Callable[[str], None], keep: int) -> None:
        present = [_VERSION.match(c) for c in self._children(self.path(name))]
        number = max([int(m.group(1)) for m in present if m], default=0) + 1
        write(self._version(name, number))
        finished = self._finished(name)
        # A run writes one version at a time, so what is not finished by now was left by a dead run.
        dead = [int(m.group(1)) for m in present if m and int(m.group(1)) not in finished]
        for old in [*finished[:-keep], *dead]:
            forget_bucketed(self.spark, self._version(name, old))
            self._remove(self._version(name, old))

    # -- tables that only grow

    def add(self, name: str, df: DataFrame) -> None:
        """Add rows as a part of their own; a part counts only once it is finished."""
        present = [_VERSION.match(c) for c in self._children(self.path(name))]
        number = max([int(m.group(1)) for m in present if m], default=0) + 1
        df.write.parquet(self._version(name, number))

    def parts(self, name: str, schema: T.StructType) -> DataFrame:
        """All finished parts of a table that grows."""
        finished = [self._version(name, n) for n in self._finished(name)]
        if not finished:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*finished)

    # -- partitioned tables

    def overwrite_partition(self, name: str, df: DataFrame, values: dict[str, object]) -> DataFrame:
        """Replace only the partition named by ``values``; an empty frame empties it.

        Spark writes the rows beside the table and swaps the folder in when all are written, so a
        run that dies leaves the old rows, and the partition may be read while it is replaced.
        """
        seen = Observation()
        rows = df.withColumns({k: F.lit(v).cast(df.schema[k].dataType) for k, v in values.items()})
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*values)
            .parquet(self.path(name))
        )
        if not seen.get["rows"]:
            self._remove("/".join([self.path(name), *(f"{k}={v}" for k, v in values.items())]))
        return self.read_partition(name, df.schema, values)

    def overwrite_partitions(self, name: str, df: DataFrame, by: list[str]) -> DataFrame:
        """Replace every partition that occurs in ``df``, in one pass over it."""
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(self.path(name))
        )
        return self.read(name, df.schema)

    def append_partitions(self, name: str, df: DataFrame, by: list[str]) -> None:
        """Add rows to the partitions that they are in; files that are there stay as they are."""
        df.write.mode("append").partitionBy(*by).parquet(self.path(name))

    def drop_partition(self, name: str, values: dict[str, object]) -> None:
        self._remove("/".join([self.path(name), *(f"{k}={v}" for k, v in values.items())]))

    def read_partition(
        self, name: str, schema: T.StructType, values: dict[str, object]
    ) -> DataFrame:
        """Rows of the given partition values; other partitions are pruned, not scanned."""
        out = self.read_or_empty(name, schema)
        for column, value in values.items():
            out = out.filter(F.col(column) == F.lit(value))
        return out

    # -- listing and removal

    def listing(self) -> DataFrame:
        """Names of all tables, for the retention rule."""
        return self.spark.createDataFrame([(n,) for n in self._children(self.root)], "name string")

    def days(self, name: str) -> list[str]:
        """Names of what a folder kept by day holds."""
        return self._children(self.path(name))

    def drop(self, name: str) -> None:
        self._remove(self.path(name))

    def _remove(self, path: str) -> None:
        fs, where = self._fs(path)
        fs.delete(where, True)


def scan_side_files(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read a parquet folder that is not a table, keeping only the columns asked for."""
    return spark.read.parquet(path).select(*columns)


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make frames available to SQL text under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
