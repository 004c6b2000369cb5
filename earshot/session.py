"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import gc
import hashlib
import json
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
# Lists of scratch paths, one per open ``scratch_tables`` block.
_KEPT: list[list[str]] = []
# Folders with buckets that have a catalog entry in this session.
_BUCKETED: set[str] = set()
# Tables between stages repeat ids and texts; of the codecs Spark has with it this one leaves least on disk.
CODEC = "zstd"

# Runtime SQL settings the jobs rely on; all are safe to set on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one more exchange later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark 4.1 takes a union of bucketed scans for bucketed as well, but reads it without lining the buckets up: a distinct over it left repeats.
    "spark.sql.unionOutputPartitioning": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    own = _LOCAL_DIRS.get(spark.sparkContext.applicationId)
    if not own:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return own


def name_local_dir(spark: SparkSession) -> None:
    """Name a folder for a session on one machine (``local[n]``) that has none set, as checks and benchmarks do.

    Nothing happens on a cluster, where the setting is needed.
    """
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if app not in _LOCAL_DIRS and (master == "local" or master.startswith("local[")):
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="earshot-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def persist_table(df: DataFrame, label: str, folders: Sequence[str] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends at the files. ``folders``: the last columns, if each value gets a folder."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    note_scratch(path)
    df.write.option("compression", CODEC).partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _bucket_name(path: str) -> str:
    return f"earshot_{hashlib.md5(path.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, by: str, buckets: int) -> None:
    """Write rows as files by bucket of a column, and note the column and the number of buckets beside them.

    A task writes one file for each bucket that it has rows of, so rows that are not dealt out by the column yet should be. The
    catalog entry that Spark needs for writing is dropped again: a table is its folder.
    """
    spark, name = df.sparkSession, _bucket_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.format("parquet").bucketBy(buckets, by).option("path", path).option("compression", CODEC).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_buckets")
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(json.dumps({"by": by, "buckets": buckets}).encode()))
    out.close()


def bucket_note(spark: SparkSession, path: str) -> dict | None:
    """The column and number of buckets of a folder; none if it has no buckets."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_buckets")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def read_bucketed(spark: SparkSession, path: str, df_schema) -> DataFrame:
    """A folder with buckets as a frame that joins and aggregates by their column without an exchange; a plain frame without."""
    note = bucket_note(spark, path)
    if note is None:
        return spark.read.schema(df_schema).parquet(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df_schema.fields)
    name = _bucket_name(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{note['by']}`) INTO {note['buckets']} BUCKETS LOCATION '{path}'"
    )
    _BUCKETED.add(path)
    return spark.table(name)


def forget_bucketed(spark: SparkSession, path: str) -> None:
    """Drop the catalog entry of a folder that goes."""
    if path in _BUCKETED:
        spark.sql(f"DROP TABLE IF EXISTS {_bucket_name(path)}")
        _BUCKETED.discard(path)


def persist_bucketed(df: DataFrame, label: str, by: str, buckets: int) -> DataFrame:
    """As ``persist_table``, by bucket."""
    path = scratch_path(df.sparkSession, label)
    note_scratch(path)
    write_bucketed(df, path, by, buckets)
    return read_bucketed(df.sparkSession, path, df.schema)


def note_scratch(path: str) -> None:
    """Have the open ``scratch_tables`` and ``noted_tables`` blocks know a path."""
    for kept in _KEPT:
        kept.append(path)


@contextmanager
def noted_tables() -> Iterator[list[str]]:
    """The paths of the tables persisted inside the block."""
    paths: list[str] = []
    _KEPT.append(paths)
    try:
        yield paths
    finally:
        _KEPT[:] = [kept for kept in _KEPT if kept is not paths]


def drop_tables(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete persisted tables that nothing reads any more."""
    for path in paths:
        forget_bucketed(spark, path)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables persisted inside the block when it ends."""
    with noted_tables() as paths:
        try:
            yield
        finally:
            drop_tables(spark, paths)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of stages that are done, which stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def joined_in_place(spark: SparkSession) -> Iterator[None]:
    """Inside the block, sides that are dealt out by some of a join's columns are joined where they are.

    Only for joins whose rows are few for each value of those columns: with skewed ones Spark should deal by all of them.
    """
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)
