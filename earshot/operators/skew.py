"""Joins, replication and numbering that stay even when one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.session import persist_table

# A key is hot when it holds more than this share of the rows. At most 1 / HOT_SHARE keys can
# be hot, so the list of hot keys has a proven bound and may be broadcast.
HOT_SHARE = 0.0001
# ... and never below this many rows, so small inputs are joined as they are.
HOT_ROWS = 200_000
# A lookup table is broadcast only after a check that it has at most this many rows and bytes.
LOOKUP_ROWS = 1_000_000
LOOKUP_BYTES = 64 * 1024 * 1024
# Copies of one row are spread over this many rows per task.
COPIES_PER_ROW = 100_000


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Keys that hold too many rows, with the number of pieces to cut them into.

    Only the key columns are read and counts are combined before the shuffle. With ``weight``
    the frame is itself a table of counts per key (such as the comment dimension), so no pass
    over the rows is needed. Each piece holds at most ``share`` of the rows, hence the pieces
    add up to at most 2 / share.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    limit = F.greatest(df.agg(rows).scalar() * F.lit(share), F.lit(float(min_rows)))
    return (
        df.groupBy(*keys)
        .agg(rows.alias("_rows"))
        .filter(F.col("_rows") > limit)
        .select(*keys, F.ceil(F.col("_rows") / limit).cast("int").alias("_pieces"))
    )


def skew_join(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread: Sequence[str] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join of a frame that may repeat a key any number of times with one that does not.

    With a table of hot keys, rows of a hot key are spread over pieces by a hash of ``spread``
    (so a retried task sends each row to the same piece) and the matching rows of ``one`` are
    copied to every piece. Take that table from stored counts, such as the response counts of
    the comment dimension: finding it by a second pass over ``many`` would repeat its lineage.
    Without it, the join is left to Spark's run-time splitting of skewed partitions, which
    ``session.configure`` turns on for every such join.
    """
    on = list(on)
    if hot is None:
        return many.join(one, on, how)
    spread = list(spread) if spread else [c for c in many.columns if c not in on]
    # Hot keys may be named by some of the join's columns only.
    by = [c for c in on if c in hot.columns]
    hot = F.broadcast(hot)
    cut = (
        many.join(hot, by, "left")
        .withColumn(
            "_piece",
            F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_pieces")), F.lit(0)).cast("int"),
        )
        .drop("_pieces")
    )
    copied = (
        one.join(hot, by, "left")
        .withColumn(
            "_piece",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)),
        )
        .drop("_pieces")
    )
    return cut.join(copied, [*on, "_piece"], how).drop("_piece")


def is_small(df: DataFrame, max_rows: int = LOOKUP_ROWS, max_bytes: int = LOOKUP_BYTES) -> bool:
    """Check of a lookup table's size in rows and text bytes; reads ``max_rows`` + 1 rows at most."""
    width = F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns]))
    size = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).head()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def lookup_join(
    many: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = LOOKUP_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join with a lookup table: broadcast when its checked size allows, else shuffled."""
    if is_small(lookup, max_rows):
        return many.join(F.broadcast(lookup), list(on), how)
    return skew_join(many, lookup, on, how, hot=hot)


def repeat_rows(df: DataFrame, copies: str, per_row: int = COPIES_PER_ROW) -> DataFrame:
    """Emit every row ``copies`` times with its copy number in ``_copy`` (from 0).

    A row with billions of copies is first cut into blocks that are spread over the cluster,
    so no task writes more than its share.
    """
    few = df.filter(F.col(copies) <= per_row).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1))
    )
    blocks = df.filter(F.col(copies) > per_row).withColumn(
        "_block",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / per_row))),
    )
    first = F.col("_block") * per_row
    last = F.least(first + per_row, F.col(copies)) - 1
    many = (
        blocks.repartition(*[F.col(c) for c in blocks.columns])
        .withColumn("_copy", F.explode(F.sequence(first, last)))
        .drop("_block")
    )
    return few.unionByName(many).drop(copies)


def numbered(df: DataFrame, digits: int = 3) -> DataFrame:
    """Number all rows 1..n in a fixed order without bringing them into one task.

    Equal rows are counted first (so copies cost nothing). The order is that of a short digest of the
    whole row, then of its columns. The distinct rows are range-partitioned by it, into as many
    parts as the data needs, and stored once; parts' starting numbers come from a running sum
    over one row per part.
    """
    columns = df.columns
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    counted = (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_digest", F.substring(F.md5(F.concat_ws("|", *text)), 1, digits))
    )
    order = [F.col("_digest"), *[F.col(c).asc_nulls_first() for c in columns]]
    parts = counted.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    parts = persist_table(parts, "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parts.groupBy("_part")
        .agg(F.sum("_n").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        parts.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(F.broadcast(starts), "_part")
        .select(*columns, (F.col("_start") + F.col("_before")).alias("_first"), "_n")
    )
    return repeat_rows(placed, "_n").select(
        *columns, (F.col("_first") + F.col("_copy") + 1).alias("RowNumber")
    )


def newest_first(date: Column, *ties: Column) -> Column:
    """Sort key whose minimum is the latest date, then the smallest tie-breakers."""
    return F.struct((-date).alias("d"), *[t.alias(f"t{i}") for i, t in enumerate(ties)])
