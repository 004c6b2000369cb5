"""Connected components of a table of links, by repeated star contraction.

Every round rewrites links so that nodes point at smaller ones: first each node's larger neighbours to the smallest node around,
then each node's smaller neighbours. Minima come from combining aggregates, so a node that a third of all links share is no
trouble. Rounds end when the links no longer change; their number grows with the logarithm of a component's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import Scratch


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (a, b); the component is its smallest node. Loops and repeats do no harm."""
    scratch = Scratch(links.sparkSession)
    # links (a, b) with a > b
    tidy = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now, path = scratch.store(tidy, "links")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        # larger neighbours go to the smallest node around: link (a, b) has a > b, so it is b's turn
        large = now.join(least, F.col("b") == F.col("n")).select("a", F.col("m").alias("b")).distinct()
        smaller = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = large.join(smaller, F.col("a") == F.col("n"))
        small = small.select(F.col("b").alias("x"), "m").unionByName(small.select(F.col("a").alias("x"), "m"))
        following, next_path = scratch.store(small.where("x > m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct(), "links")
        scratch.drop(path)
        now, path, before = following, next_path, mark
        mark = _mark(now)
        if mark == before:
            break
    labels = now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    return labels.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
