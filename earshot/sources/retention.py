"""Choosing buffer tables that are past their retention."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.dates import int_to_date
from earshot.sources.tables import TableStore

# How buffer tables are told apart and where their date stands in the name.
BUFFER_MARK = "_buffer_"
DATE_IN_NAME = r"(?<![\p{L}\p{N}])(\d{8})(?![\p{L}\p{N}])"


def expired_tables(listing: DataFrame, run_date: int, retention_days: int) -> DataFrame:
    """Buffer tables dated ``retention_days`` or more before the run date.

    Names without a readable date are kept, as are tables that are no buffers.
    """
    stamp = F.regexp_extract("name", DATE_IN_NAME, 1)
    dated = listing.filter(F.contains("name", F.lit(BUFFER_MARK))).withColumn(
        "TableDate", F.to_date(F.try_to_timestamp(stamp, F.lit("yyyyMMdd")))
    )
    last = F.date_sub(int_to_date(F.lit(run_date)), retention_days)
    return dated.filter(F.col("TableDate") <= last)


def drop_expired(store: TableStore, expired: DataFrame) -> list[str]:
    """Delete the chosen tables; a store has a few tables per day, so the list is short."""
    names = [r["name"] for r in expired.select("name").toLocalIterator()]
    for name in names:
        store.drop(name)
    return names


def drop_old_days(store: TableStore, log: str, run_date: int, keep_days: int) -> list[str]:
    """Delete the days of a log folder that lie ``keep_days`` or more before the run date."""
    last = (datetime.strptime(str(run_date), "%Y%m%d") - timedelta(days=keep_days)).strftime("%Y%m%d")
    old = [d for d in store.days(log) if len(d) == 8 and d.isdigit() and d <= last]
    for day in old:
        store.drop(f"{log}/{day}")
    return old
