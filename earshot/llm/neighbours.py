"""Approximate nearest neighbours by cosine, with a graph made by NN-descent.

Equal vectors are one node. First neighbours come from blocks of ``START_BLOCK`` nodes that follow one another in ``STARTS`` orders
by the signs of random projections: an order is a range partitioning, so no block can grow. Then rounds of NN-descent: every
node meets its neighbours and the nodes it is a neighbour of (the nearest ``MEET`` of them), and those that it brings together
are told of one another, if that betters the worst neighbour they have. Pairs that met at the same node in the round before are
not told again. Each node keeps its ``DEGREE`` nearest. Rounds go on until one replaces at most ``SETTLED`` of all edges. The
graph is fitted on all nodes.

A query starts at its own node and searches greedily: it visits the neighbours, both ways, of the nearest ``BEAM`` nodes seen so
far that were not opened yet, until all of them are open. What it found is then measured with its original vector in double
precision, and copies are listed by their smallest ids. Vectors travel as unit vectors in half precision; only the final measure
is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import Scratch, distilled, empty_as, mapped

NEAREST = 5
QUERY_STEP = 50
DEGREE = 32
MEET = 64
SETTLED = 0.001
STARTS = 4
START_BLOCK = 256
SIGNS = 8
BEAM = 160
SEED = 11

EDGES = "u long, v long, near float"
LISTS = "u long, guests array<long>, fresh array<long>"


def usable(table: DataFrame) -> DataFrame:
    """Vectors that take part, as doubles: not null, without null or non-finite components, not zero, of the usual dimension."""
    rows = table.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vec")).where("vec_id IS NOT NULL AND vec IS NOT NULL")
    good = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.where(good)
    usual = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).select("dim")
    return rows.join(F.broadcast(usual), F.size("vec") == F.col("dim")).drop("dim")


def _units(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def _packed(units: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in units.astype(np.float16)], pa.binary())


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(len(column), -1).astype(np.float32)


def nodes(vectors: DataFrame) -> DataFrame:
    """(node, unit) of every distinct vector."""
    distinct = vectors.select(F.xxhash64("vec").alias("node"), "vec").groupBy("node").agg(F.first("vec").alias("vec"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([batch.column(0), _packed(_units(batch.column(1)))], names=["node", "unit"])

    return mapped(distinct, run, "node long, unit binary")


def _top(edges: DataFrame, most: int) -> DataFrame:
    """The nearest ``most`` distinct v of every u."""
    fresh = [F.min("fresh").alias("fresh")] if "fresh" in edges.columns else []  # an edge told of again is not fresh
    best = edges.groupBy("u", "v").agg(F.max("near").alias("near"), *fresh)
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("near"), "v"))
    return best.withColumn("r", rank).where(F.col("r") <= most).drop("r")


def _best_of(close: np.ndarray, most: int) -> np.ndarray:
    """Places of the largest values of every row."""
    most = min(most, close.shape[1])
    return np.argpartition(-close, most - 1, axis=1)[:, :most]


def first_neighbours(points: DataFrame, degree: int = DEGREE) -> DataFrame:
    """Edges between nodes that lie in one block of an order."""
    spark = points.sparkSession
    # every partition has some blocks to itself; a single block's worth of nodes stays together
    width = min(int(spark.conf.get("spark.sql.shuffle.partitions")), points.count() // (2 * START_BLOCK))
    out = None
    for start in range(STARTS):

        def order(batch: pa.RecordBatch, start=start) -> Iterator[pa.RecordBatch]:
            x = _matrix(batch.column(1))
            planes = np.random.default_rng(SEED + start).normal(size=(x.shape[1], SIGNS + 1)).astype(np.float32)
            y = x @ planes
            cell = (y[:, :SIGNS] > 0) @ (1 << np.arange(SIGNS))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell + 0.5 + np.arctan(y[:, SIGNS]).astype(np.float64) / 4)], names=["node", "unit", "place"])

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            size = 0
            for batch in batches:
                held.append(batch)
                size += batch.num_rows
                while size >= 2 * START_BLOCK:
                    whole = pa.Table.from_batches(held)
                    yield meet(whole.slice(0, START_BLOCK))
                    held = whole.slice(START_BLOCK).to_batches()
                    size -= START_BLOCK
            if size > 1:
                yield meet(pa.Table.from_batches(held))

        def meet(rows: pa.Table) -> pa.RecordBatch:
            node, x = rows.column("node").to_numpy(), _matrix(rows.column("unit"))
            close = x @ x.T
            np.fill_diagonal(close, -9)
            best = _best_of(close, min(degree, len(node) - 1))
            near = np.take_along_axis(close, best, 1)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(node, best.shape[1])), pa.array(node[best].ravel()), pa.array(near.ravel())], names=["u", "v", "near"])

        placed = mapped(points, order, "node long, unit binary, place double")
        dealt = placed.repartitionByRange(width, "place") if width > 1 else placed.coalesce(1)
        edges = dealt.sortWithinPartitions("place", "node").mapInArrow(blocks, EDGES)
        out = edges if out is None else out.unionByName(edges)
    return out


def both_ways(graph: DataFrame, most: int) -> DataFrame:
    """The nearest ``most`` nodes that are neighbours of a node or have it as one."""
    return _top(graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "near")), most)


def meetings(graph: DataFrame, before: DataFrame) -> DataFrame:
    """(u, guests, fresh) of every node: the nodes that it brings together, and those that it did not bring together ``before``."""
    now = both_ways(graph, MEET).groupBy("u").agg(F.collect_list("v").alias("guests"))
    known = before.select("u", F.col("guests").alias("known"))
    fresh = F.array_except("guests", F.coalesce("known", F.array().cast("array<long>")))
    return now.join(known, "u", "left").select("u", "guests", fresh.alias("fresh"))


def introductions(graph: DataFrame, points: DataFrame, lists: DataFrame) -> DataFrame:
    """Edges between nodes that a common neighbour brings together for the first time, where they better the worst edge of u.

    A node hears of its ``DEGREE`` nearest at each common neighbour: others could not be among its ``DEGREE`` nearest of all.
    """
    worst = graph.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("least")).select(F.col("u").alias("w"), F.when(F.col("n") >= DEGREE, F.col("least")).otherwise(F.lit(-9.0)).cast("float").alias("worst"))
    guests = points.withColumnRenamed("node", "w").join(worst, "w")
    invited = lists.where(F.size("fresh") > 0).select("u", F.explode("guests").alias("w"), "fresh").select("u", "w", F.array_contains("fresh", F.col("w")).alias("fresh"))
    width = int(graph.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows < 8192:
                continue
            host = held.column("u").to_numpy()
            edge = int(np.searchsorted(host, host[-1]))
            if edge:
                yield told(held.slice(0, edge))
                held = held.slice(edge)
        if held is not None and held.num_rows:
            yield told(held)

    def told(rows: pa.Table) -> pa.RecordBatch:
        host, guest, x, worst = rows.column("u").to_numpy(), rows.column("w").to_numpy(), _matrix(rows.column("unit")), rows.column("worst").to_numpy()
        fresh = rows.column("fresh").to_numpy()
        edge = np.append(np.flatnonzero(np.concatenate([[True], host[1:] != host[:-1]])), len(host))
        us, vs, nears = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
        for a, b in zip(edge, edge[1:], strict=False):
            if b - a < 2:
                continue
            close = x[a:b] @ x[a:b].T
            np.fill_diagonal(close, -9)
            old = np.flatnonzero(~fresh[a:b])
            close[np.ix_(old, old)] = -9
            best = _best_of(close, min(DEGREE, b - a - 1))
            near = np.take_along_axis(close, best, 1)
            better = near > worst[a:b, None]
            row, column = np.nonzero(better)
            us.append(guest[a:b][row])
            vs.append(guest[a:b][best[row, column]])
            nears.append(near[row, column])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs)), pa.array(np.concatenate(nears).astype(np.float32))], names=["u", "v", "near"])

    return invited.join(guests, "w").select("u", "w", "unit", "worst", "fresh").repartition(width, "u").sortWithinPartitions("u").mapInArrow(run, EDGES)


def build(points: DataFrame, settled: float = SETTLED) -> DataFrame:
    """The neighbour graph (u, v, near) of the nodes."""
    spark = points.sparkSession
    scratch = Scratch(spark)
    edges, path = scratch.store(_top(first_neighbours(points).withColumn("fresh", F.lit(True)), DEGREE), "graph")
    scratch.tidy()
    lists, lists_path = empty_as(LISTS, spark), None
    while True:  # every round that goes on has bettered edges, so there is a last one
        graph = edges.drop("fresh")
        following, next_lists_path = scratch.store(meetings(graph, lists), "lists")
        if lists_path:
            scratch.drop(lists_path)
        lists, lists_path = following, next_lists_path
        both = edges.withColumn("fresh", F.lit(False)).unionByName(introductions(graph, points, lists).withColumn("fresh", F.lit(True)))
        following, next_path = scratch.store(_top(both, DEGREE), "graph")
        scratch.drop(path)
        scratch.tidy()
        edges, path = following, next_path
        total, replaced = edges.agg(F.count(F.lit(1)), F.count_if("fresh")).first()
        if replaced <= settled * total:
            return edges.drop("fresh")


def search(starts: DataFrame, points: DataFrame, graph: DataFrame, beam: int = BEAM) -> DataFrame:
    """(q, w) for queries (q, a node): nodes found by greedy search, the nearest ``beam`` of each."""
    scratch = Scratch(points.sparkSession)
    around = both_ways(graph, 2 * DEGREE).select(F.col("u").alias("from"), F.col("v").alias("w"))
    around, _ = scratch.store(around, "around")
    mine = starts.select("q").distinct().join(points, F.col("q") == F.col("node")).select("q", F.col("unit").alias("mine"))
    mine, _ = scratch.store(mine, "queries")
    found, path = scratch.store(mine.select("q", F.col("q").alias("w"), F.lit(2.0).cast("float").alias("near"), F.lit(False).alias("opened")), "found")

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        near = np.einsum("ij,ij->i", _matrix(batch.column(2)), _matrix(batch.column(3)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near.astype(np.float32))], names=["q", "w", "near"])

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("near"), "w"))
    while True:  # every hop that goes on betters the beam, so there is a last one
        frontier = found.where(~F.col("opened")).select("q", F.col("w").alias("from"))
        if frontier.isEmpty():
            return found.select("q", "w")
        step = frontier.join(around, "from").select("q", "w").distinct()
        pairs = step.join(points.withColumnRenamed("node", "w"), "w").join(mine, "q").select("q", "w", "unit", "mine")
        new = mapped(pairs, measure, "q long, w long, near float").withColumn("opened", F.lit(False))
        # nodes that fell out of the beam may be measured again, but are no nearer than before
        both = found.withColumn("opened", F.lit(True)).unionByName(new).groupBy("q", "w").agg(F.max("near").alias("near"), F.max("opened").alias("opened"))
        following, next_path = scratch.store(both.withColumn("r", rank).where(F.col("r") <= beam).drop("r"), "found")
        scratch.drop(path)
        scratch.tidy()
        found, path = following, next_path


def nearest(table: DataFrame, step: int = QUERY_STEP, most: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: of each vector whose id is divisible by ``step`` the ``most`` nearest others found.

    Rows whose vector is null, zero, or holds null or non-finite components, and rows without an id, take no part. Scores are cosines
    of the original vectors in double precision; equal scores go by the smaller vec_id. A row is no candidate of its own; rows that
    repeat both id and vector are one. An id with several vectors is a query, and a candidate, with each of them.
    """
    scratch = Scratch(table.sparkSession)
    vectors, _ = scratch.store(usable(table).distinct().withColumn("node", F.xxhash64("vec")), "vectors")
    points, _ = scratch.store(nodes(vectors), "nodes")
    queries = vectors.where(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("query_id"), F.col("node").alias("q"), F.col("vec").alias("query"))
    found = distilled(table.sparkSession, "found", lambda: search(queries.select("q"), points, build(points)))
    # of copies, only the first can be among the nearest: one more than asked for, as one may be the query itself
    first = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    few = vectors.withColumn("r", first).where(F.col("r") <= most + 1).select(F.col("node").alias("w"), "vec_id", "vec")
    # the nearest nodes by the rough measure, with room for its error, are measured exactly
    pairs = queries.join(found, "q").join(few, "w").where("query_id != vec_id OR q != w")
    dot = F.aggregate(F.zip_with("query", "vec", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def norm(c: str):
        return F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))

    scored = pairs.select("query_id", "q", "vec_id", (dot / (norm("query") * norm("vec"))).alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", place).where(F.col("rank") <= most).select("query_id", "rank", "vec_id", "score")
