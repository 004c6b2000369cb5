"""Hard negatives: bounds by segment summaries, and whole results against every pair scored."""

import math

import numpy as np
import pytest

from earshot.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<float>, label int, row string, key string, x int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, "r", "k", 1, "s") for i, v, c in rows], SCHEMA).repartition(4)


def plain(rows, is_anchor, positives=5, negatives=10):
    good = [(i, c, [math.floor(256 * float(np.float32(e))) for e in v]) for i, v, c in rows if c is not None and v is not None and all(e is not None and math.isfinite(e) for e in v)]
    out = []
    for a, (anchor, label, x) in enumerate(good):
        if anchor is None or not is_anchor(anchor):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i is None, i or 0, b) for b, (i, _, y) in enumerate(good))
        near = [s for s in scored if s[3] != a and good[s[3]][1] == label][:positives]
        for score, _, _, p in near:
            far = [s for s in scored if good[s[3]][1] != label and 30 * -score <= 100 * -s[0] <= 90 * -score][:negatives]
            out += [(anchor, good[p][0], r + 1, good[s[3]][0], -score, -s[0]) for r, s in enumerate(far)]
    return out


def clustered(seed, n, d, smooth):
    """Vectors around a few centres; smooth ones change little from entry to entry, so that coarse segments tell much."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, d))
    v = centres[rng.integers(0, 7, n)] + 0.4 * rng.normal(size=(n, d))
    if smooth:
        v = np.cumsum(v, axis=1) / d
    return [(int(i), [float(e) for e in r], int(c)) for i, (r, c) in enumerate(zip(v, rng.integers(0, 4, n)))]


@pytest.mark.parametrize("smooth", [False, True])
@pytest.mark.parametrize("level", range(len(hard.SEGMENTS)))
def test_bounds_hold(smooth, level):
    x = np.array([np.floor(256 * np.array(v)) for _, v, _ in clustered(level, 200, 32, smooth)]).astype(np.int64)
    sums, spread = hard.summaries(x)
    ends = np.cumsum([32 // s for s in hard.SEGMENTS])
    rows = hard.Block(np.arange(200), np.zeros(200), x, np.split(sums.astype(float), ends[:-1], axis=1), np.split(spread.astype(float), ends[:-1], axis=1))
    middle, reach = hard.bounds(rows, rows, level)
    score = x @ x.T
    assert (score <= middle + reach).all() and (score >= middle - reach).all()
    if level:
        assert reach.sum() < hard.bounds(rows, rows, level - 1)[1].sum()


def test_candidates_are_pruned_but_complete():
    x = np.array([np.floor(256 * np.array(v)) for _, v, _ in clustered(4, 600, 64, True)]).astype(np.int64)
    sums, spread = hard.summaries(x)
    ends = np.cumsum([64 // s for s in hard.SEGMENTS])
    rows = hard.Block(np.arange(600), np.arange(600) % 3, x, np.split(sums.astype(float), ends[:-1], axis=1), np.split(spread.astype(float), ends[:-1], axis=1))
    anchors = rows.take(slice(0, 20))
    score = x @ x[:20].T
    low = np.sort(score, axis=0)[-30][None, :]
    i, j, got = hard.candidates(rows, anchors, (low, np.full_like(low, hard.ANY)), False)
    wanted = {(a, b) for a, b in zip(*np.nonzero((score >= low) & (rows.label[:, None] != anchors.label[None, :])))}
    assert wanted <= set(zip(i, j)) and (got == score[i, j]).all()
    assert len(i) < 0.3 * score.size


@pytest.mark.parametrize("smooth,d", [(False, 64), (True, 20)])
def test_against_all_pairs(spark, monkeypatch, smooth, d):
    monkeypatch.setattr(hard, "SHARD", 16)  # several shards
    rows = clustered(1, 500, d, smooth)
    rows += [(1000 + k, rows[40][1], 1) for k in range(120)]  # a large group of copies, and ties
    rows += [(40, rows[40][1], rows[40][2])] * 3 + [(None, rows[41][1], 2), (None, rows[41][1], 3)]
    rows += [(3000, None, 1), (3010, rows[0][1], None), (3020, [*rows[0][1][:-1], None], 1), (3030, [float("nan")] * d, 1), (3040, [float("inf")] + rows[0][1][1:], 2)]
    rows += [(3050, [0.0] * d, 1), (3060, [], 1), (3070, [1.0], 2), (3080, [-e for e in rows[0][1]], 77)]
    is_anchor = lambda i: i % 10 == 0
    got = hard.mine(frame(spark, rows), is_anchor).collect()
    order = lambda r: tuple(-1 if c is None else c for c in r)
    assert sorted(map(order, map(tuple, got))) == sorted(map(order, plain(rows, is_anchor)))


def test_nothing_to_mine(spark):
    assert hard.mine(frame(spark, []), hard.is_anchor).count() == 0
    assert hard.mine(frame(spark, [(100, [], 1), (200, None, 1)]), hard.is_anchor).count() == 0
    assert hard.mine(frame(spark, [(1, [1.0], 1), (2, [1.0], 2)]), hard.is_anchor).count() == 0
    assert hard.mine(frame(spark, [(100, [1.0], 1), (2, [0.5], 2)]), hard.is_anchor).count() == 0


def test_moved_labels(spark):
    rows = [(i, [1.0], c) for i, c in ((7, 9), (14, None), (8, 9), (None, 3), (0, -1), (21, -5))]
    got = {r.vec_id: r.label for r in hard.with_moved_labels(frame(spark, rows)).collect()}
    assert got == {7: 0, 14: None, 8: 9, None: 3, 0: 0, 21: -4}
