"""Fuzzy duplicates: the nearest known comments by embedding, confirmed by edit distance.

The join is exact, and asks for little: comments of some length are first joined by spelling (``edit_join``), and only those with
a close partner look for their nearest known comments by vector, as short comments do.

Vectors are searched through a tree of cells. Known vectors are split around a bounded number of pivots; cells that are still too
large for a task are split again around pivots of their own, which are sampled, joined and assigned in Spark, so their number
grows with the known side and never visits the driver. A new vector first meets a block of its own cell; if that holds as many neighbours
as are wanted, the last one's cosine is the vector's limit from then on. It is sent to every cell that can hold a vector within its
limit (geometric bounds rule the others out); what is still crowded, such as copies, is cut into blocks. Inside a task a block
is split once more, and a new vector's nearest ones so far raise its limit, so that most of the block is never compared.
A task emits only the best few neighbours per new comment, so neither a crowded cell nor a crowd of near copies is ever
emitted as pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.operators import edit_join
from earshot.operators.skew import skew_join
from earshot.schemas import DUPLICATE_MAP
from earshot.session import persist_table

# The task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Limits of the match.
MIN_COSINE = 0.95
MAX_EDITS = 15
NEIGHBOURS = 5

# Largest number of cells; at most this many pivot vectors visit the driver.
CELLS = 1024
# Rows of either side in one block, and rows compared at a time: a slice's cosines take 64 MB.
# Every vector travels once per block of the other side, so blocks are as large as memory allows.
BLOCK_ROWS = 16384
SLICE_ROWS = 512
# Rows of a block that are not worth splitting.
LOCAL_ROWS = 64
# Slack that keeps rounding from ruling out a cell.
SLACK = 1e-6
# What rounding a cosine to nine digits can add to it, with some to spare.
ROUNDED = 1e-9


def unit_rows(vectors: pd.Series) -> np.ndarray:
    """Vectors as the rows of a matrix, each of length one (a zero vector stays zero)."""
    matrix = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def reachable_cells(
    vectors: np.ndarray, pivots: np.ndarray, radius: np.ndarray, min_cosine: float | np.ndarray
) -> np.ndarray:
    """Mask (vector, cell) of cells that may hold a vector with the wanted cosine (one for all or one each).

    A cell holds vectors nearest to its pivot and within ``radius`` (an angle) of it. Ruled out
    are cells farther than radius plus the limit's angle, and cells whose dividing plane to the
    vector's own cell is farther away than the limit's chord.
    """
    dots = vectors @ pivots.T
    least = np.broadcast_to(min_cosine, len(vectors))[:, None]
    angle = np.arccos(np.clip(least, -1.0, 1.0))
    chord = np.sqrt(np.maximum(0.0, 2.0 * (1.0 - least)))
    near = dots.argmax(axis=1)
    squares = (pivots**2).sum(axis=1)
    apart = squares[:, None] + squares[None, :] - 2.0 * (pivots @ pivots.T)
    gaps = np.sqrt(np.maximum(apart, 0.0))[near]
    behind_plane = dots - dots.max(axis=1, keepdims=True) >= -chord * gaps - SLACK
    within = np.arccos(np.clip(dots, -1.0, 1.0)) <= radius[None, :] + angle + SLACK
    mask = behind_plane & within & (radius >= 0)[None, :]
    # A zero vector has cosine 0 with everything, which geometry does not cover.
    zero = ~vectors.any(axis=1)
    mask[zero] = least[zero] <= 0
    return mask


def best_columns(values: np.ndarray, least: float | np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the largest ``most`` values of each row that reach ``least`` (one for all or one each); ties go to the first column."""
    least = np.broadcast_to(least, len(values))
    hit = np.flatnonzero((values >= least[:, None]).any(axis=1))
    part, floor = values[hit], least[hit]
    if part.shape[1] > most and len(hit):
        floor = np.maximum(floor, -np.partition(-part, most - 1, axis=1)[:, most - 1])
    row, column = np.nonzero(part >= floor[:, None])
    value = part[row, column]
    order = np.lexsort((column, -value, row))
    row, column, value = row[order], column[order], value[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < most
    return hit[row[keep]], column[keep], value[keep]


def nearest_within(
    rows: np.ndarray, columns: np.ndarray, least: float | np.ndarray, most: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, column, cosine) of each row's nearest ``most`` columns within the limit (one for all or one each), and how many pairs were compared.

    Vectors are of length one or zero; cosines are rounded, ties go to the first column. Columns are split around every so many-th
    of them. A row first meets the cell it is nearest to; its ``most``-th cosine there is its limit for the others.
    """
    count = int(np.sqrt(len(columns))) if len(columns) >= 4 * LOCAL_ROWS else 1
    pivots = columns[:: len(columns) // count][:count]
    theirs, mine = columns @ pivots.T, rows @ pivots.T
    home, near = theirs.argmax(axis=1), mine.argmax(axis=1)
    radius = np.zeros(count)
    np.maximum.at(radius, home, np.arccos(np.clip(theirs[np.arange(len(columns)), home], -1.0, 1.0)))
    order = np.argsort(home, kind="stable")
    bounds = np.searchsorted(home[order], np.arange(count + 1))
    inside = [order[bounds[c] : bounds[c + 1]] for c in range(count)]
    limit, compared, found = np.array(np.broadcast_to(least, len(rows)), dtype=float), rows.shape[0] * count + columns.shape[0] * count, []

    def meet(c: int, who: np.ndarray) -> None:
        nonlocal compared
        if not len(who) or not len(inside[c]):
            return
        cosines = np.round(rows[who] @ columns[inside[c]].T, 9)
        compared += cosines.size
        i, j, value = best_columns(cosines, limit[who], most)
        found.append((who[i], inside[c][j], value))
        place = np.arange(len(i)) - np.searchsorted(i, i)
        full = place == most - 1
        limit[who[i[full]]] = np.maximum(limit[who[i[full]]], value[full])

    for c in range(count):
        meet(c, np.flatnonzero(near == c))
    angles = np.arccos(np.clip(mine, -1.0, 1.0))
    for c in np.argsort(-(mine.mean(axis=0))):
        top = np.cos(np.maximum(0.0, angles[:, c] - radius[c] - SLACK))
        meet(c, np.flatnonzero((near != c) & (top >= limit - SLACK)))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0), compared
    row, column, value = (np.concatenate(part) for part in zip(*found))
    order = np.lexsort((column, -value, row))
    row, column, value = row[order], column[order], value[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < most
    return row[keep], column[keep], value[keep], compared


def _frame(rows: pd.DataFrame, **columns) -> pd.DataFrame:
    """Ids and vectors as plain objects (whatever string type pandas uses) plus new columns."""
    out = {c: pd.Series(rows[c].to_numpy(dtype=object), dtype=object) for c in ("CommentId", "Vector")}
    return pd.DataFrame({**out, **columns})


def _pivots(known: DataFrame, cells: int) -> np.ndarray:
    """A bounded, repeatable sample of known vectors: those with the smallest digests."""
    rows = known.orderBy(F.xxhash64("CommentId"), "CommentId").limit(cells).select("Vector").toPandas()
    return unit_rows(rows["Vector"]) if len(rows) else np.zeros((0, 0))


def _homes(known: DataFrame, pivots: np.ndarray) -> DataFrame:
    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                dots = unit_rows(frame["Vector"]) @ pivots.T
                home = dots.argmax(axis=1)
                angle = np.arccos(np.clip(dots.max(axis=1), -1.0, 1.0))
                yield _frame(frame, Cell=home.astype("int32"), Angle=angle)

    return known.select("CommentId", "Vector").mapInPandas(
        assign, "CommentId string, Vector array<double>, Cell int, Angle double"
    )


def _visits(new: DataFrame, pivots: np.ndarray, radius: np.ndarray) -> DataFrame:
    """(CommentId, Vector, Limit, Cell): the cells that can hold a vector within the row's limit."""

    def list_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), SLICE_ROWS):
                part = frame.iloc[start : start + SLICE_ROWS]
                mask = reachable_cells(unit_rows(part["Vector"]), pivots, radius, part["Limit"].to_numpy() - ROUNDED)
                yield _frame(part, Limit=part["Limit"].to_numpy(), Cells=[np.nonzero(m)[0].astype("int32") for m in mask])

    listed = new.select("CommentId", "Vector", "Limit").mapInPandas(
        list_cells, "CommentId string, Vector array<double>, Limit double, Cells array<int>"
    )
    return listed.select("CommentId", "Vector", "Limit", F.explode("Cells").alias("Cell"))


def _split(homes: DataFrame, crowded: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows of crowded cells with a cell of their own inside it (``Sub``), and these: (Cell, Sub, Pivot, Radius).

    ``crowded`` has the cells and their sizes. Pivots are sampled by a hash of the id, about two for each block of rows, so they need no
    order and no rank. Rows are dealt out in pieces, and a cell's pivots go to each of its pieces. Rows of a cell without
    a pivot stay together, without a bound.
    """
    rows = homes.join(F.broadcast(crowded), "Cell")
    share = F.lit(2.0) / F.lit(float(block_rows))
    drawn = F.pmod(F.xxhash64("CommentId", F.lit("pivot")), F.lit(1_000_000)) < share * 1_000_000
    pivots = persist_table(rows.filter(drawn).select("Cell", F.col("CommentId").alias("Sub"), F.col("Vector").alias("Pivot")), "fuzzy-pivots")
    pieces = crowded.select("Cell", F.ceil(F.col("Size") / block_rows).cast("int").alias("Pieces"))
    cut = rows.join(F.broadcast(pieces), "Cell").withColumn("Piece", F.pmod(F.xxhash64("CommentId"), F.col("Pieces")).cast("int"))
    copied = pivots.join(F.broadcast(pieces), "Cell").withColumn("Piece", F.explode(F.sequence(F.lit(0), F.col("Pieces") - 1)))

    def assign(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(theirs):
            return _frame(mine, Cell=mine["Cell"].astype("int32"), Sub=pd.Series([""] * len(mine), dtype=object), Angle=mine["Angle"]) if len(mine) else mine.assign(Sub="", Angle=0.0)[["CommentId", "Vector", "Cell", "Sub", "Angle"]]
        theirs = theirs.sort_values("Sub", kind="stable")
        dots = unit_rows(mine["Vector"]) @ unit_rows(theirs["Pivot"]).T
        names = theirs["Sub"].to_numpy(dtype=object)[dots.argmax(axis=1)]
        angle = np.arccos(np.clip(dots.max(axis=1), -1.0, 1.0))
        return _frame(mine, Cell=mine["Cell"].to_numpy().astype("int32"), Sub=pd.Series(names, dtype=object), Angle=angle)

    out = (
        cut.select("Cell", "Piece", "CommentId", "Vector", "Angle").groupBy("Cell", "Piece")
        .cogroup(copied.select("Cell", "Piece", "Sub", "Pivot").groupBy("Cell", "Piece"))
        .applyInPandas(assign, "CommentId string, Vector array<double>, Cell int, Sub string, Angle double")
    )
    out = persist_table(out, "fuzzy-subs")
    reach = out.groupBy("Cell", "Sub").agg(F.max("Angle").alias("Radius"))
    return out, persist_table(reach.join(pivots, ["Cell", "Sub"], "left").select("Cell", "Sub", "Pivot", "Radius"), "fuzzy-leaves")


def _sub_visits(visits: DataFrame, leaves: DataFrame, block_rows: int) -> DataFrame:
    """Visits to crowded cells become visits to the cells inside that can hold a vector within the row's limit."""
    load = visits.groupBy("Cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("Pieces"))
    cut = visits.join(load, "Cell").withColumn("Piece", F.pmod(F.xxhash64("CommentId"), F.col("Pieces")).cast("int"))
    copied = leaves.join(load, "Cell").withColumn("Piece", F.explode(F.sequence(F.lit(0), F.col("Pieces") - 1)))

    def choose(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        parts = [pd.DataFrame({"CommentId": [], "Vector": [], "Limit": [], "Cell": [], "Sub": []}).astype({"CommentId": object, "Vector": object, "Cell": "int32", "Sub": object})]
        names = theirs["Sub"].to_numpy(dtype=object)
        bare = theirs["Pivot"].isna().to_numpy()
        pivots = unit_rows(theirs["Pivot"][~bare]) if (~bare).any() else None
        for start in range(0, len(mine), SLICE_ROWS):
            part = mine.iloc[start : start + SLICE_ROWS]
            rows, least = unit_rows(part["Vector"]), part["Limit"].to_numpy() - ROUNDED
            limit = np.arccos(np.clip(least, -1.0, 1.0))
            mask = np.ones((len(part), len(theirs)), dtype=bool)
            if pivots is not None:
                angle = np.arccos(np.clip(rows @ pivots.T, -1.0, 1.0))
                mask[:, ~bare] = angle <= theirs["Radius"].to_numpy()[~bare][None, :] + limit[:, None] + SLACK
            zero = ~rows.any(axis=1)
            mask[zero] = least[zero, None] <= 0
            i, j = np.nonzero(mask)
            parts.append(_frame(part.iloc[i].reset_index(drop=True), Limit=part["Limit"].to_numpy()[i], Cell=part["Cell"].to_numpy()[i].astype("int32"), Sub=pd.Series(names[j], dtype=object)))
        return pd.concat(parts, ignore_index=True)

    return (
        cut.select("Cell", "Piece", "CommentId", "Vector", "Limit").groupBy("Cell", "Piece")
        .cogroup(copied.select("Cell", "Piece", "Sub", "Pivot", "Radius").groupBy("Cell", "Piece"))
        .applyInPandas(choose, "CommentId string, Vector array<double>, Limit double, Cell int, Sub string")
    )


def _compared(homes: DataFrame, visits: DataFrame, neighbours: int, block_rows: int) -> DataFrame:
    """(CommentId, KnownCommentId, Cosine): the nearest known comments of each visit's cell, block by block, within the visit's limit."""
    leaf = ["Cell", "Sub"]
    cut = lambda n: F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(n)
    cuts = persist_table(homes.groupBy(*leaf).agg(cut("KnownCuts")).join(visits.groupBy(*leaf).agg(cut("NewCuts")), leaf), "fuzzy-cuts")
    piece = F.xxhash64("CommentId")
    known_blocks = (
        homes.join(cuts, leaf)
        .withColumn("KnownBlock", F.pmod(piece, F.col("KnownCuts")).cast("int"))
        .withColumn("NewBlock", F.explode(F.sequence(F.lit(0), F.col("NewCuts") - 1)))
        .select(*leaf, "KnownBlock", "NewBlock", "CommentId", "Vector")
    )
    new_blocks = (
        visits.join(cuts, leaf)
        .withColumn("NewBlock", F.pmod(piece, F.col("NewCuts")).cast("int"))
        .withColumn("KnownBlock", F.explode(F.sequence(F.lit(0), F.col("KnownCuts") - 1)))
        .select(*leaf, "KnownBlock", "NewBlock", "CommentId", "Vector", "Limit")
    )

    def compare(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"CommentId": [], "KnownCommentId": [], "Cosine": []}).astype({"CommentId": object, "KnownCommentId": object})]
        if len(mine) and len(theirs):
            theirs = theirs.sort_values("CommentId", kind="stable")
            ids = mine["CommentId"].to_numpy(dtype=object)
            others = theirs["CommentId"].to_numpy(dtype=object)
            columns = unit_rows(theirs["Vector"])
            for start in range(0, len(mine), SLICE_ROWS):
                part = mine.iloc[start : start + SLICE_ROWS]
                i, j, value, _ = nearest_within(unit_rows(part["Vector"]), columns, part["Limit"].to_numpy(), neighbours)
                if len(i):
                    out.append(pd.DataFrame({"CommentId": ids[start + i], "KnownCommentId": others[j], "Cosine": value}))
        return pd.concat(out, ignore_index=True)

    keys = [*leaf, "KnownBlock", "NewBlock"]
    return (
        new_blocks.groupBy(*keys)
        .cogroup(known_blocks.groupBy(*keys))
        .applyInPandas(compare, "CommentId string, KnownCommentId string, Cosine double")
    )


def _limits(new: DataFrame, homes: DataFrame, pivots: np.ndarray, sizes: dict[int, int], min_cosine: float, neighbours: int, block_rows: int) -> DataFrame:
    """(CommentId, Vector, Limit): the new comments with the cosine that their nearest ones reach.

    It is that of the last wanted neighbour in a block of the comment's own cell, so the nearest of all are no farther away, or the limit
    for all where the block does not hold so many.
    """
    crowded = [(c, -(-n // block_rows)) for c, n in sizes.items() if n > block_rows]
    drawn = homes.withColumn("Sub", F.lit(""))
    if crowded:
        pieces = F.broadcast(new.sparkSession.createDataFrame(crowded, "Cell int, Pieces int"))
        first = F.pmod(F.xxhash64("CommentId", F.lit("limit")), F.coalesce("Pieces", F.lit(1))) == 0
        drawn = drawn.join(pieces, "Cell", "left").filter(first).drop("Pieces")
    asked = _homes(new, pivots).select("CommentId", "Vector", F.lit(float(min_cosine)).alias("Limit"), "Cell", F.lit("").alias("Sub"))
    met = _compared(drawn, persist_table(asked, "fuzzy-asked"), neighbours, block_rows)
    order = Window.partitionBy("CommentId").orderBy(F.desc("Cosine"))
    last = met.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") == neighbours)
    limits = persist_table(last.select("CommentId", F.col("Cosine").alias("_reached")), "fuzzy-limits")
    return new.join(limits, "CommentId", "left").select("CommentId", "Vector", F.greatest(F.col("_reached") - 2 * ROUNDED, F.lit(float(min_cosine))).alias("Limit"))


def nearest_known(
    new: DataFrame,
    known: DataFrame,
    min_cosine: float = MIN_COSINE,
    neighbours: int = NEIGHBOURS,
    cells: int = CELLS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(CommentId, KnownCommentId, Cosine, Place): the nearest known comments within the limit.

    Both frames have CommentId and Vector (array of double), one row per comment. Cosines are
    rounded to nine digits; equal ones are ordered by the known comment's id.
    """
    spark = new.sparkSession
    # Each side is read several times below, so it is stored once, without its texts.
    vector = F.col("Vector").cast("array<double>").alias("Vector")
    new = persist_table(new.select("CommentId", vector), "fuzzy-new")
    known = persist_table(known.select("CommentId", vector), "fuzzy-known")
    # Few vectors need few cells: a cell should hold about half a block.
    pivots = _pivots(known, min(cells, 1 + 2 * known.count() // block_rows))
    if not len(pivots):
        return spark.createDataFrame(
            [], "CommentId string, KnownCommentId string, Cosine double, Place int"
        )
    homes = persist_table(_homes(known, pivots), "fuzzy-homes")
    # One row per cell comes back: its reach and its size.
    reach = homes.groupBy("Cell").agg(F.max("Angle").alias("r"), F.count(F.lit(1)).alias("n")).toPandas()
    radius = np.full(len(pivots), -1.0)
    radius[reach["Cell"]] = reach["r"]
    sizes = {int(c): int(n) for c, n in zip(reach["Cell"], reach["n"])}
    limited = _limits(new, homes, pivots, sizes, min_cosine, neighbours, block_rows)
    visits = persist_table(_visits(limited, pivots, radius), "fuzzy-visits")
    homes, visits = homes.withColumn("Sub", F.lit("")), visits.withColumn("Sub", F.lit(""))
    large = [(c, n) for c, n in sizes.items() if n > block_rows]
    if large:
        crowded = spark.createDataFrame(large, "Cell int, Size long")
        names = crowded.select("Cell")
        subs, leaves = _split(homes.drop("Sub"), crowded, block_rows)
        inner = _sub_visits(visits.drop("Sub").join(F.broadcast(names), "Cell", "left_semi"), leaves, block_rows)
        homes = homes.join(F.broadcast(names), "Cell", "left_anti").unionByName(subs)
        visits = persist_table(visits.join(F.broadcast(names), "Cell", "left_anti").unionByName(inner), "fuzzy-sub-visits")
    best = _compared(homes, visits, neighbours, block_rows)
    order = Window.partitionBy("CommentId").orderBy(F.desc("Cosine"), "KnownCommentId")
    return best.withColumn("Place", F.row_number().over(order)).filter(F.col("Place") <= neighbours)


def fuzzy_duplicate_map(
    new: DataFrame,
    known: DataFrame,
    min_cosine: float = MIN_COSINE,
    max_edits: int = MAX_EDITS,
    neighbours: int = NEIGHBOURS,
    cells: int = CELLS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """For each new comment the first of its nearest known ones that is also close in spelling.

    Frames have CommentId, SurveyComment and Vector, one row per comment. A limit over ``edit_join.MOST_EDITS`` leaves everything to the vectors.
    """
    texts = known.select(
        F.col("CommentId").alias("KnownCommentId"),
        F.col("SurveyComment").alias("SurveyCommentDeduped"),
    )
    short = F.length("SurveyComment") < edit_join.least_length(max_edits) if max_edits <= edit_join.MOST_EDITS else F.lit(True)
    spelled = persist_table(
        edit_join.close_pairs(new.filter(~short), texts.withColumnRenamed("SurveyCommentDeduped", "SurveyComment"), max_edits)
        if max_edits <= edit_join.MOST_EDITS
        else new.sparkSession.createDataFrame([], "CommentId string, KnownCommentId string"),
        "fuzzy-spelled",
    )
    # Long comments with a close partner, and short ones, look for their place among the nearest.
    asked = new.filter(short).unionByName(new.filter(~short).join(spelled.select("CommentId").distinct(), "CommentId", "left_semi"))
    near = persist_table(nearest_known(asked, known, min_cosine, neighbours, cells, block_rows), "fuzzy-near")
    whole = skew_join(near, texts, ["KnownCommentId"]).join(new.select("CommentId", "SurveyComment"), "CommentId")
    sure = whole.filter(~short).join(spelled, ["CommentId", "KnownCommentId"], "left_semi")
    tried = whole.filter(short).filter(edit_join.spelled_alike("SurveyComment", "SurveyCommentDeduped", max_edits))
    row = F.struct("KnownCommentId", "SurveyComment", "SurveyCommentDeduped")
    return (
        sure.unionByName(tried.select(*sure.columns))
        .groupBy("CommentId")
        .agg(F.min_by(row, "Place").alias("_m"))
        .select("CommentId", "_m.*", F.lit(None).cast("int").alias("ReportingDate"))
        .select(*DUPLICATE_MAP.names)
    )


def maintain_duplicate_map(old: DataFrame, fresh: DataFrame) -> DataFrame:
    """The map with pairs for comments it does not have; a comment keeps the pair it got first."""
    best = F.min_by(F.struct(*[c for c in DUPLICATE_MAP.names if c != "CommentId"]), "KnownCommentId")
    one = fresh.join(old.select("CommentId"), "CommentId", "left_anti").groupBy("CommentId").agg(best.alias("_pair"))
    return old.unionByName(one.select("CommentId", "_pair.*").select(*old.columns))


def stamp_reported_pairs(duplicate_map: DataFrame, added: DataFrame, run_date: int) -> DataFrame:
    """Stamp the pairs whose rows went into the report; earlier stamps stay."""
    ids = added.select("CommentId").distinct().withColumn("_added", F.lit(True))
    return (
        duplicate_map.join(ids, "CommentId", "left")
        .withColumn(
            "ReportingDate",
            F.coalesce("ReportingDate", F.when(F.col("_added"), F.lit(run_date))),
        )
        .select(*duplicate_map.columns)
    )
