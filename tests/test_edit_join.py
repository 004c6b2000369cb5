"""The spelling join against the edit distance of every pair, and the search inside a block."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.operators import edit_join, fuzzy


def distance(a, b, limit):
    """Edit distance by rows of the table; None beyond the limit."""
    if abs(len(a) - len(b)) > limit:
        return None
    b_codes = np.array([ord(c) for c in b])
    row = np.arange(len(b) + 1)
    for i, c in enumerate(a, 1):
        best = np.minimum(row[1:] + 1, row[:-1] + (b_codes != ord(c)))
        new = np.concatenate([[i], best])
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row[-1]) if row[-1] <= limit else None


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            out.insert(at, rng.choice("abcéz "))
        elif out and kind == 1:
            del out[min(at, len(out) - 1)]
        elif out:
            out[min(at, len(out) - 1)] = rng.choice("abcéz ")
    return "".join(out)


@pytest.mark.parametrize("limit", [0, 3, 15])
@pytest.mark.parametrize("hot", [False, True])
def test_close_pairs_equal_brute_force(spark, limit, hot):
    rng = random.Random(limit)
    least = edit_join.least_length(limit)
    words = ["aa", "b", "abc", "é", "zab", "cc "]
    say = lambda n: "".join(rng.choice(words) for _ in range(n))[:n]
    greeting = say(40)  # a piece that many share
    known = [say(rng.randint(max(1, least - limit - 2), least + 60)) for _ in range(60)]
    known += [greeting + say(rng.randint(least, least + 20)) for _ in range(40)] + [say(least)[: limit + 1], "", known[3]]
    new = [t for _ in range(3) for k in known if len(t := edited(rng, k, rng.randint(0, limit + 2))) >= least]
    new += ["x" * 9 + k for k in known[:5] if len(k) + 9 >= least] + [k[:-3] + "yyy" for k in known[:9] if len(k) >= least]
    frame = lambda rows, name: spark.createDataFrame([(f"{i:04d}", t) for i, t in enumerate(rows)], f"{name} string, SurveyComment string")
    limits = {"share": 0.001, "min_rows": 5} if hot else {}
    got = edit_join.close_pairs(frame(new, "CommentId"), frame(known, "KnownCommentId"), limit, **limits)
    want = {(f"{i:04d}", f"{j:04d}") for i, a in enumerate(new) for j, b in enumerate(known) if distance(a, b, limit) is not None}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 40


def test_rows_grow_with_texts_only(spark):
    """Keys of a text do not depend on the others: their number is bounded by the limit."""
    rng = random.Random(7)
    texts = [("".join(rng.choice("abcdefgh ") for _ in range(n)),) for n in (79, 80, 200, 5000)]
    frame = spark.createDataFrame(texts, "t string")
    row = frame.select(F.size(edit_join.piece_keys(F.col("t"), 15)).alias("p"), F.size(edit_join.probe_keys(F.col("t"), F.length("t"), 15)).alias("q")).agg(F.max("p"), F.max("q")).head()
    assert row[0] == 16 and row[1] <= 3 * 256


@pytest.mark.parametrize("least", [-1.0, 0.0, 0.5, 0.9])
def test_search_inside_a_block(least):
    rng = np.random.default_rng(3)
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1), 1e-300)[:, None]
    centres = rng.normal(size=(12, 10))
    columns = centres[rng.integers(0, 12, 900)] + rng.normal(scale=0.2, size=(900, 10))
    columns[40:300:7] = columns[40]  # ties
    columns[5] = 0
    rows = centres[rng.integers(0, 12, 150)] + rng.normal(scale=0.2, size=(150, 10))
    rows[0] = 0
    rows[1] = columns[40]
    columns, rows = unit(columns), unit(rows)
    i, j, value, compared = fuzzy.nearest_within(rows, columns, least, 5)
    cosines = np.round(rows @ columns.T, 9)
    want = [(a, int(b)) for a in range(150) for b in np.argsort(-cosines[a], kind="stable")[:5] if cosines[a, b] >= least]
    assert list(zip(i.tolist(), j.tolist(), strict=True)) == want
    assert (value == cosines[i, j]).all()
    assert compared < cosines.size / 2 + 30 * (len(rows) + len(columns))


def test_long_comments_ask_for_vectors_only_when_spelled_alike(spark, monkeypatch):
    """Only the new comments with a close partner, and short ones, are searched by vector; the map is that of searching all."""
    rng = random.Random(11)
    say = lambda n: "".join(rng.choice("abcdefghij klm") for _ in range(n))
    known = [say(rng.randint(5, 300)) for _ in range(120)]
    new = [edited(rng, k, rng.randint(0, 12)) for k in known[:60]] + [say(rng.randint(5, 300)) for _ in range(60)]
    letters = "abcdefghij klm"
    frame = lambda rows, p: spark.createDataFrame([(f"{p}{i:04d}", t, [float(t.count(c)) for c in letters]) for i, t in enumerate(rows)], "CommentId string, SurveyComment string, Vector array<double>")
    asked = []
    searched = fuzzy.nearest_known
    monkeypatch.setattr(fuzzy, "nearest_known", lambda n, *rest: asked.append(n.count()) or searched(n, *rest))
    got = fuzzy.fuzzy_duplicate_map(frame(new, "n"), frame(known, "k")).collect()
    monkeypatch.setattr(fuzzy.edit_join, "MOST_EDITS", -1)  # all by vector
    plain = fuzzy.fuzzy_duplicate_map(frame(new, "n"), frame(known, "k")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain)) and len(got) > 30
    short = sum(len(t) < edit_join.least_length(15) for t in new)
    assert asked[1] == len(new) and asked[0] <= short + 60


@pytest.mark.parametrize("limit", [0, 1, 4, 15, 40])
def test_diagonals_equal_the_table(limit):
    rng = random.Random(limit)
    say = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    texts = [say(rng.randint(0, 120)) for _ in range(150)]
    pairs = [(t, edited(rng, t, rng.randint(0, limit + 4))) for t in texts] + [(t, say(len(t))) for t in texts]
    got = [edit_join.within_edits(a.encode(), b.encode(), limit) for a, b in pairs]
    assert got == [distance(a, b, limit) is not None for a, b in pairs] and any(got) and not all(got)


def test_long_texts_cost_their_length(spark):
    """A table of a pair of 300,000 characters takes minutes."""
    rng = random.Random(5)
    known = ["".join(rng.choices("abcdefgh é", k=300_000)) for _ in range(16)]
    near = [t[3:70] + "zz" + t[75:] + "!!" for t in known]
    frame = lambda rows: spark.createDataFrame(list(enumerate(rows)), "i int, a string")
    both = frame(known).join(frame(near).withColumnRenamed("a", "b"), "i")
    both = both.withColumn("c", F.concat(F.substring("b", 1, 299_000), F.repeat(F.lit("-"), 999)))
    start = time.monotonic()
    assert both.filter(edit_join.spelled_alike("a", "b", 15)).count() == 16
    assert both.filter(edit_join.spelled_alike("a", "c", 15)).count() == 0
    assert time.monotonic() - start < 60
