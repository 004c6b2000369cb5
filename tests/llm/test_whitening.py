"""Whitening: exact polynomials and roots, and whole results against numpy."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from earshot.llm import exact_roots as roots
from earshot.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, key string, v int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "k", 1, "n") for i, v in rows], SCHEMA).repartition(3)


def plain(rows, components=16):
    """Integer rows by the contract, and the covariance of the distinct ones."""
    good = [(i, v) for i, v in rows if v is not None and all(e is not None and math.isfinite(e) for e in v)]
    size = max((len(v) for _, v in good), default=0)
    x = {k: tuple(int(math.floor(64 * float(np.float32(e)))) + 1_000_000 for e in (*v, *[0.0] * (size - len(v)))) for k, (i, v) in enumerate(good)}
    fit = np.array(sorted(set(x.values())), dtype=object)
    return good, x, fit


def poly_by_newton(matrix):
    """The characteristic polynomial by the Faddeev-LeVerrier recursion, in fractions."""
    d, m, out = len(matrix), [[Fraction(0)] * len(matrix) for _ in matrix], [Fraction(1)]
    a = [[Fraction(v) for v in row] for row in matrix]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        out.append(-sum(a[i][t] * m[t][i] for i in range(d) for t in range(d)) / k)
    return [int(c) for c in reversed(out)]


@pytest.mark.parametrize("seed", range(6))
def test_polynomial_by_residues(seed):
    rng = random.Random(seed)
    d = rng.randint(1, 9)
    b = [[rng.choice([0, 0, 1, -3, 10**6]) for _ in range(d)] for _ in range(max(1, d - seed % 3))]
    m = [[sum(r[i] * r[j] for r in b) for j in range(d)] for i in range(d)]
    primes = roots.primes_for(roots.coefficient_bound(m))
    assert roots.combined(primes, roots.residues(m, np.array(primes)).tolist()) == poly_by_newton(m)


def test_roots_with_multiplicities():
    wanted = [(Fraction(9), 1), (Fraction(5), 3), (Fraction(3, 2), 1), (Fraction(1, 1024), 2)]
    poly = [Fraction(0), Fraction(1)]  # and a root of zero
    for value, times in wanted:
        for _ in range(times):
            poly = [(poly[i - 1] if i else 0) - value * (poly[i] if i < len(poly) else 0) for i in range(len(poly) + 1)]
    scale = math.lcm(*[c.denominator for c in map(Fraction, poly)])
    got = roots.largest_roots([int(c * scale) for c in poly], 99)
    assert [t for _, t in got] == [t for _, t in wanted]
    assert all(abs(a / b - 1) < Fraction(1, 1 << 200) for (a, _), (b, _) in zip(got, wanted))
    assert [t for _, t in roots.largest_roots([int(c * scale) for c in poly], 2)] == [1, 3]


def test_null_vectors_of_a_repeated_root():
    block = np.array([[2, 1], [1, 1]])
    m = np.kron(np.eye(3, dtype=int), block).tolist()
    primes = roots.primes_for(roots.coefficient_bound(m))
    found = roots.largest_roots(roots.combined(primes, roots.residues(m, np.array(primes)).tolist()), 6)
    v = np.array([[float(e) for e in u] for r, t in found for u in roots.null_vectors(m, r, t)])
    values = np.repeat([float(r) for r, _ in found], [t for _, t in found])
    assert np.abs(v @ v.T - np.eye(6)).max() < 1e-14
    assert np.abs(np.array(m) @ v.T - v.T * values).max() < 1e-14


def rows_of(seed, n=300, d=20):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) / 5
    rows = [(int(i), [float(e) for e in v]) for i, v in enumerate(mixed)]
    rows += [(1000 + k, rows[k][1]) for k in range(40)] + [(5, rows[5][1])] * 30  # copies, repeated rows
    rows += [(2000, None), (2001, [None] * d), (2002, [*rows[0][1][:-1], None]), (2003, [float("nan")] * d), (2004, [float("inf"), *rows[1][1][1:]]), (None, rows[3][1]), (2005, [0.5]), (2006, [])]
    return rows


def test_against_numpy(spark):
    rows = rows_of(3)
    good, x, fit = plain(rows)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit.astype(float) - (s / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 16 * len(good)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    share = {r.component: r.explained for r in got}
    assert np.allclose([share[c] for c in range(1, 17)], values / np.trace(centred.T @ centred / n), rtol=1e-9)
    wanted = sorted((-1 if i is None else i, sum(int(n * a - b) ** 2 for a, b in zip(x[k], s)), *np.round(np.abs((np.array(x[k], float) - (s / n).astype(float)) @ vectors / np.sqrt(values)), 6)) for k, (i, _) in enumerate(good))
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation, ), {}).setdefault(r.component, []).append(r.whitened)
    mine = sorted((-1 if i is None else i, dev, *(round(abs(w[c][0]), 6) for c in range(1, 17))) for (i, dev), w in by_row.items() for _ in w[1])
    assert [m[:2] for m in mine] == [w[:2] for w in wanted]
    assert np.allclose(np.array([m[2:] for m in mine]), np.array([w[2:] for w in wanted]), atol=2e-6)
    # one sign per component
    for c in range(16):
        signs = {bool((w[c + 1][0] > 0) == ((np.array(x[k], float) - (s / n).astype(float)) @ vectors[:, c] > 0)) for k, (i, _) in enumerate(good) for w in [by_row[(i, sum(int(n * a - b) ** 2 for a, b in zip(x[k], s)))]] if abs(w[c + 1][0]) > 1e-3}
        assert len(signs) == 1


def test_large_entries_are_exact(spark):
    rows = [(i, [float(2**40 + 3 * i), float(-(2**41) + i * i), 1.0 * (i % 3)]) for i in range(20)]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(wide)
    x = [[math.floor(64 * e) + 1_000_000 for e in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    dev = {r.vec_id: r.deviation for r in got.collect()}
    assert dev == {i: sum((20 * a - b) ** 2 for a, b in zip(v, s)) for i, v in enumerate(x)}
    assert got.first().identity_error < 1e-6


def test_no_variance(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [0.5, 1.0])] * 3)).count() == 0
    assert whitening.whiten(frame(spark, [(1, []), (2, None)])).count() == 0
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12
