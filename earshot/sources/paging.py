"""Numbered pages, batches, and keyed change sets."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.skew import numbered
from earshot.session import persist_table

# The task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: rows per page and per batch.
PAGE_SIZE = 1000


def with_pages(df: DataFrame, page_size: int = PAGE_SIZE, name: str = "Page") -> DataFrame:
    """Number the rows and give each its 0-based page (or batch)."""
    return numbered(df).withColumn(
        name, F.floor((F.col("RowNumber") - 1) / F.lit(page_size)).cast("long")
    )


def store_pages(df: DataFrame, page_size: int = PAGE_SIZE, name: str = "Page") -> DataFrame:
    """``with_pages``, numbered once and stored with a folder for each page: reading a page lists and opens its own files only."""
    ordered = with_pages(df, page_size, name).repartitionByRange("RowNumber").sortWithinPartitions("RowNumber")
    return persist_table(ordered, "pages", [name])


def each_page(paged: DataFrame, page_size: int = PAGE_SIZE, name: str = "Page") -> Iterator[DataFrame]:
    """The pages in order. Folders of the pages that ``paged`` was numbered with (``name``) are skipped, also for another ``page_size``."""
    rows, stored = paged.agg(F.max("RowNumber"), F.count_if(F.col(name) == 0)).first()
    for offset in range(0, rows or 0, page_size):
        held = F.col(name).between(offset // stored, (offset + page_size - 1) // stored)
        yield read_page(paged, offset, page_size).filter(held)


def read_page(paged: DataFrame, offset: int, page_size: int = PAGE_SIZE) -> DataFrame:
    """The page that starts at row ``offset``; empty past the end."""
    return paged.filter(
        (F.col("RowNumber") > F.lit(offset)) & (F.col("RowNumber") <= F.lit(offset + page_size))
    )


def _paired(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on null-safe keys; each side becomes a struct that is null when absent."""
    left = old.select(F.struct(*old.columns).alias("_old"))
    right = new.select(F.struct(*new.columns).alias("_new"))
    same = [F.col("_old")[k].eqNullSafe(F.col("_new")[k]) for k in keys]
    return left.join(right, same, "full_outer")


def change_set(target: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What to insert, update and delete to turn ``target`` into ``wanted``.

    ``keys`` identify a row in both; the remaining columns are its content.
    """
    columns = wanted.columns
    both = _paired(target.select(*columns), wanted, keys)
    old, new = F.col("_old"), F.col("_new")
    action = (
        F.when(old.isNull(), "insert")
        .when(new.isNull(), "delete")
        .when(~old.eqNullSafe(new), "update")
    )
    return both.select(
        action.alias("Action"), *[F.coalesce(new, old)[c].alias(c) for c in columns]
    ).filter(F.col("Action").isNotNull())


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after its inserts, updates and deletes.

    A change whose key is in the wrong state (insert of a present row, update or delete of an
    absent one) does nothing, as with a keyed store. One row per key on either side.
    """
    columns = target.columns
    both = _paired(target, changes.select(*columns, "Action"), keys)
    old, new = F.col("_old"), F.col("_new")
    act = F.coalesce(new["Action"], F.lit(""))
    stays = (old.isNotNull() & (act != "delete")) | (old.isNull() & (act == "insert"))
    takes_new = old.isNull() | (act == "update")
    return both.filter(stays).select(
        *[F.when(takes_new, new[c]).otherwise(old[c]).alias(c) for c in columns]
    )


def affected_rows(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(Action, Requested, Affected): how many changes there are and how many take effect."""
    have = target.select(*[F.col(k).alias(f"_{k}") for k in keys]).withColumn("_is", F.lit(True))
    seen = changes.join(have, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
    works = F.when(F.col("Action") == "insert", F.col("_is").isNull()).otherwise(
        F.col("_is").isNotNull()
    )
    return seen.groupBy("Action").agg(
        F.count(F.lit(1)).alias("Requested"), F.count_if(works).alias("Affected")
    )


def send_batches(
    df: DataFrame, send: Callable[[list[dict]], int], batch_size: int = PAGE_SIZE
) -> DataFrame:
    """Hand rows to a remote keyed store in batches and total the rows it reports changed.

    Each task sends its own batches; a retried task sends them again, so ``send`` must be keyed
    (repeating it must not change the outcome).
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                rows = frame.iloc[start : start + batch_size].to_dict("records")
                yield pd.DataFrame({"Rows": [len(rows)], "Affected": [int(send(rows))]})

    return df.mapInPandas(run, "Rows long, Affected long").agg(
        F.count(F.lit(1)).alias("Batches"),
        F.coalesce(F.sum("Rows"), F.lit(0)).alias("Rows"),
        F.coalesce(F.sum("Affected"), F.lit(0)).alias("Affected"),
    )
