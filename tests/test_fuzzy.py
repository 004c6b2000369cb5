"""The blocked neighbour join against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.operators import fuzzy


def vectors(spark, prefix, matrix):
    rows = [(f"{prefix}{i:04d}", f"text {prefix} {i}", [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "CommentId string, SurveyComment string, Vector array<double>")


def brute(new, known, limit, neighbours):
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1) > 0, np.linalg.norm(m, axis=1), 1)[:, None]
    cos = np.round(unit(new) @ unit(known).T, 9)
    out = set()
    for i in range(len(new)):
        order = np.argsort(-cos[i], kind="stable")[:neighbours]
        out |= {(f"n{i:04d}", f"k{j:04d}", p + 1) for p, j in enumerate(order) if cos[i, j] >= limit}
    return out


@pytest.mark.parametrize("limit", [0.95, 0.6, 0.0])
def test_blocks_and_cells_equal_brute_force(spark, limit, monkeypatch):
    monkeypatch.setattr(fuzzy, "SLICE_ROWS", 16)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, 12))
    # A third of the known vectors crowd round one centre; some are exact copies, one is zero.
    pick = np.where(rng.random(400) < 0.33, 0, rng.integers(0, 9, 400))
    known = centres[pick] + rng.normal(scale=0.25, size=(400, 12))
    known[10] = known[11] = known[12]
    known[13] = 0
    new = centres[rng.integers(0, 9, 120)] + rng.normal(scale=0.25, size=(120, 12))
    new[0] = known[10]
    new[1] = 0
    got = fuzzy.nearest_known(
        vectors(spark, "n", new), vectors(spark, "k", known), limit, 5, cells=16, block_rows=40
    )
    assert {(r["CommentId"], r["KnownCommentId"], r["Place"]) for r in got.collect()} == brute(new, known, limit, 5)


def test_cells_are_ruled_out_and_never_wrongly():
    rng = np.random.default_rng(1)
    unit = lambda m: m / np.linalg.norm(m, axis=1)[:, None]
    pivots = unit(rng.normal(size=(40, 6)))
    points = unit(pivots[rng.integers(0, 40, 3000)] + rng.normal(scale=0.1, size=(3000, 6)))
    home = (points @ pivots.T).argmax(axis=1)
    radius = np.array([np.arccos(np.clip((points @ pivots.T)[home == c, c], -1, 1)).max(initial=-1) for c in range(40)])
    asked = unit(pivots[rng.integers(0, 40, 300)] + rng.normal(scale=0.1, size=(300, 6)))
    mask = fuzzy.reachable_cells(asked, pivots, radius, 0.95)
    i, j = np.nonzero(asked @ points.T >= 0.95)
    assert mask[i, home[j]].all() and mask.mean() < 0.5


def test_vectors_that_are_all_alike_do_not_visit_every_cell(spark, monkeypatch):
    """Texts of one language: every pair is within the limit, which alone rules no cell out."""
    visits, made = [], fuzzy._visits

    def counted(*args):
        visits.append(made(*args))
        return visits[-1]

    monkeypatch.setattr(fuzzy, "_visits", counted)
    rng = np.random.default_rng(2)
    known, new = (np.array([20.0, 15, 10, 8]) + rng.normal(scale=0.6, size=(n, 4)) for n in (1200, 150))
    got = fuzzy.nearest_known(vectors(spark, "n", new), vectors(spark, "k", known), 0.95, 5, cells=64, block_rows=40)
    assert {(r["CommentId"], r["KnownCommentId"], r["Place"]) for r in got.collect()} == brute(new, known, 0.95, 5)
    cells = 1 + 2 * 1200 // 40
    assert visits[0].count() < 150 * cells / 3


def test_first_close_neighbour_in_spelling(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "CommentId string, SurveyComment string, Vector array<double>")

    known = frame([
        ("k1", "an altogether different sentence", [1.0, 0.0]),
        ("k2", "the report is slow", [1.0, 0.02]),
        ("k3", "the report is slow!", [1.0, 0.05]),
    ])
    new = frame([("n1", "the report is slow?", [1.0, 0.0]), ("n2", "price", [0.0, 1.0])])
    got = fuzzy.fuzzy_duplicate_map(new, known).collect()
    assert [(r["CommentId"], r["KnownCommentId"], r["SurveyCommentDeduped"], r["ReportingDate"]) for r in got] == [
        ("n1", "k2", "the report is slow", None)
    ]
    # Only the nearest few are looked at, as many as asked for.
    assert fuzzy.fuzzy_duplicate_map(new, known, neighbours=1).count() == 0
    assert fuzzy.fuzzy_duplicate_map(new, known.limit(0)).count() == 0


def test_stamps_are_kept(spark):
    rows = spark.createDataFrame([("a", "x", 5), ("b", "x", None), ("c", "x", None)], "CommentId string, KnownCommentId string, ReportingDate int")
    added = spark.createDataFrame([("a",), ("b",), ("b",)], "CommentId string")
    got = {r["CommentId"]: r["ReportingDate"] for r in fuzzy.stamp_reported_pairs(rows, added, 9).collect()}
    assert got == {"a": 5, "b": 9, "c": None}


def test_best_columns_settle_ties_by_place():
    values = np.random.default_rng(1).integers(0, 6, (40, 17)) / 5.0
    row, column, value = fuzzy.best_columns(values, 0.6, 4)
    want = [(i, int(j)) for i in range(40) for j in np.argsort(-values[i], kind="stable")[:4] if values[i, j] >= 0.6]
    assert list(zip(row.tolist(), column.tolist(), strict=True)) == want and (value == values[row, column]).all()
