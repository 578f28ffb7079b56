"""Whitening against exact sums in plain Python, numpy's eigenvectors, and polynomials in fractions."""

import random
from fractions import Fraction

import numpy as np
import pytest

import sparkmart.llm.whitening as whitening
from sparkmart.llm.whitening import (
    Root,
    characteristic_polynomial,
    largest_roots,
    null_vectors,
    polynomial_modulo,
    roots_above,
    whiten,
    whitened_rows,
)

SCHEMA = "vec_id long, embedding array<double>, component string, n int"


def plain_polynomial(matrix):
    """Faddeev and LeVerrier's recurrence in fractions: elementary symmetric sums of the eigenvalues."""
    d = len(matrix)
    a = [[Fraction(int(x)) for x in row] for row in matrix]
    m, sums = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (sums[-1] * (-1) ** (k - 1) if i == j else 0) for j in range(d)] for i in range(d)]
        sums.append(-sum(a[i][t] * m[t][i] for i in range(d) for t in range(d)) / k * (-1) ** k)
    return [int(s) for s in sums]


def scatter_of(rng, d, n, spread=50):
    x = rng.integers(-spread, spread, (n, d)).astype(object)
    s = x.sum(axis=0)
    return n * (x.T @ x) - np.outer(s, s)


@pytest.mark.parametrize("d,n", [(1, 5), (2, 9), (5, 30), (6, 4), (8, 100)])
def test_polynomial_and_roots(spark, d, n):
    a = scatter_of(np.random.default_rng(d), d, n)
    sums = characteristic_polynomial(spark, a)
    assert sums == plain_polynomial(a)
    values = np.linalg.eigvalsh(a.astype(float))[::-1]
    roots = largest_roots(sums, d)
    got = [r.numerator / (1 << r.shift) for r in roots for _ in range(r.count)]
    assert len(got) == min(d, n - 1) and np.allclose(got, values[: len(got)], rtol=1e-9)


def test_hessenberg_on_matrices_that_need_swaps():
    rng = random.Random(2)
    for d in (1, 2, 3, 5, 7):
        for _ in range(20):
            m = np.array([[rng.choice([0, 0, 1, 5, -3]) for _ in range(d)] for _ in range(d)], object)
            p = 10007
            want = [(-1) ** k * s % p for k, s in enumerate(plain_polynomial(m))][::-1]
            assert polynomial_modulo(m, p) == want


def test_repeated_and_close_roots(spark):
    close = 10**30  # two eigenvalues that are the same number as doubles
    a = np.diag([7, 7, 0, close, close + 1, 7]).astype(object)
    sums = characteristic_polynomial(spark, a)
    roots = largest_roots(sums, 6)
    assert [r.count for r in roots] == [1, 1, 3]
    assert [round(Fraction(r.numerator, 1 << r.shift)) for r in roots] == [close + 1, close, 7]
    assert roots_above([1, -2, 1], 1, 0) == 0 and roots_above([1, -2, 1], 1, 1) == 2
    vectors = np.concatenate([null_vectors(a, r) for r in roots])
    assert np.allclose(vectors @ vectors.T, np.eye(5), atol=1e-14)
    assert abs(vectors[0][4]) == pytest.approx(1, abs=1e-15) and abs(vectors[1][3]) == pytest.approx(1, abs=1e-15)
    assert null_vectors(np.array([[5]], object), Root(5, 0, 1)).tolist() in ([[1.0]], [[-1.0]])


def rows_of(seed, n=120, d=20):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d))
    x = rng.normal(size=(n, d)) @ mix
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(500 + k, rows[3][1]) for k in range(40)] + [(None, rows[4][1]), (7, rows[7][1])]
    rows += [(900, None), (901, []), (902, [None] + rows[0][1][1:]), (903, [float("nan")] * d), (904, [float("inf")] + rows[0][1][1:])]
    rows += [(905, [1e300] * d), (906, [1.0, 2.0]), (907, [3.5e4] * d)]
    return rows


@pytest.mark.parametrize("seed,n,d", [(0, 120, 20), (1, 40, 3), (2, 9, 20)])
def test_against_plain_sums(spark, seed, n, d):
    rows = rows_of(seed, n, d)
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    got, model = whiten(table)
    got = got.toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    good = [(i, [int(np.floor(64 * c)) + 1_000_000 for c in v]) for i, v in rows if v and len(v) == d and None not in v and np.isfinite(v).all() and max(np.abs(v)) < 1e16]
    fit = sorted({tuple(v) for _, v in good})
    sums = [sum(v[k] for v in fit) for k in range(d)]
    many = len(fit)
    x = np.array([[c - Fraction(s, many) for c, s in zip(v, sums)] for v in fit]).astype(float)
    values, vectors = np.linalg.eigh(x.T @ x / many)
    values, vectors = values[::-1], vectors[:, ::-1].T
    count = min(16, d, many - 1)
    assert len(got) == len(good) * count and set(got.n) == {many} and set(got.component) == set(range(1, count + 1))
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    for row, (doc, v) in zip(range(3), good):
        mine = got[got.vec_id == doc].sort_values("component")
        assert set(mine.deviation) == {sum((many * c - s) ** 2 for c, s in zip(v, sums))}
        want = (np.array([float(c - Fraction(s, many)) for c, s in zip(v, sums)]) @ vectors[:count].T) / np.sqrt(values[:count])
        assert np.allclose(np.abs(mine.whitened), np.abs(want), rtol=1e-6, atol=1e-6)
        assert np.allclose(mine.explained, values[:count] / values.sum(), rtol=1e-9)
    assert np.allclose(model.components @ model.components.T, np.eye(count), atol=1e-13)


def test_large_numbers_are_exact(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(k, (rng.normal(size=4) * 1e12).tolist()) for k in range(50)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got, model = whiten(table)
    good = [[int(np.floor(64 * c)) for c in v] for _, v in rows]
    sums = [sum(v[k] for v in good) for k in range(4)]
    scatter = [[50 * sum(v[i] * v[j] for v in good) - sums[i] * sums[j] for j in range(4)] for i in range(4)]
    assert model.polynomial == plain_polynomial(scatter)
    assert model.sums == sums and {r.deviation for r in got.collect()} == {None}
    assert got.first().identity_error < 1e-9


def test_tables_without_a_spread(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.001])]):
        table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        assert whitened_rows(table).collect() == []
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, whitened_rows(table).collect()))
    assert [g[:4] for g in got] == [(1, 1, 2, 64**2), (2, 1, 2, 64**2)]
    assert sorted(round(g[4], 9) for g in got) == [-1, 1] and {g[5] for g in got} == {1.0}
