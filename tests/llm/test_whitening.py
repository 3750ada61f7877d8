"""Whitening against numpy's eigenvectors of the covariance of the distinct quantised vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from evalframe.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, component string, n string"


def vectors(n, d, seed=1, rank=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, rank or d)) @ rng.normal(size=(rank or d, d)) * rng.uniform(0.1, 2, d)
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "n") for i, v in rows], SCHEMA).repartition(3)


def plain(rows, k=4):
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    listed = np.array(sorted({tuple(x) for _, x in good}), dtype=object)
    n, sums = len(listed), listed.sum(axis=0)
    centred = (n * listed - sums).astype(float) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    far = {i: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for i, x in good}
    white = {i: (np.array(x, float) - np.array([float(s) for s in sums]) / n) @ v / np.sqrt(e) for i, x in good}
    return n, e / (centred ** 2).sum() * n, far, white


def check(spark, rows, k=4):
    df = frame(spark, rows)
    got = W.transform(df, W.fit(df)).collect()
    n, share, far, white = plain(rows, k)
    assert len(got) == sum(1 for i in [r[0] for r in rows] if i in far) * k
    signs = {}
    for r in got:
        assert r.n == n and r.deviation == far[r.vec_id] and abs(r.explained / share[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
        w = white[r.vec_id][r.component - 1]
        if abs(w) > 1e-6:
            assert signs.setdefault(r.component, np.sign(w * r.whitened)) == np.sign(w * r.whitened)   # one sign for all rows
        assert abs(abs(r.whitened) - abs(w)) < 1e-7
    return got


def test_equals_eigenvectors(spark):
    rows = vectors(300, 12)
    hot = [(1000 + i, rows[0][1]) for i in range(150)]           # a third of all rows are one vector
    odd = [(2000, None), (2001, []), (2002, [None] * 12), (2003, [float("nan")] * 12), (2004, [float("inf")] + [0.0] * 11), (None, rows[3][1]), (7, rows[5][1])]
    check(spark, [r for r in rows + hot + odd if r[0] != 7])
    check(spark, rows + hot)


@pytest.mark.parametrize("rank", [3, 1])
def test_dependent_dimensions(spark, rank):
    """Fewer directions than dimensions: as many components as there are directions of the quantised vectors; no crash."""
    rng = np.random.default_rng(2)
    base = rng.integers(-500, 500, size=(60, rank))
    rows = [(i, [float(v) / 256 for v in (b @ rng_matrix(rank))]) for i, b in enumerate(base)]
    got = check(spark, rows, k=rank)
    assert {r.component for r in got} == set(range(1, rank + 1))


def rng_matrix(rank):
    return np.random.default_rng(5).integers(-3, 4, size=(rank, 8))


def test_ill_conditioned_columns(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)) * np.array([2000.0, 300.0, 30.0, 4.0, 0.5, 0.05])
    x[:, 5] += x[:, 0]                                             # nearly the first column
    check(spark, [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)])


def test_nothing_to_fit(spark):
    none = frame(spark, [(1, None), (2, [])])
    assert W.fit(none) is None and W.transform(none, None).count() == 0
    same = frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])
    model = W.fit(same)
    assert model.n == 1 and len(model.values) == 0 and W.transform(same, model).count() == 0
    assert W.transform(frame(spark, []), None).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    two = frame(spark, [(1, [0.5, 0.25]), (2, [0.0, 0.25]), (3, [1.0])])   # one direction; a vector of another length takes no part
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9)) for r in W.transform(two, W.fit(two)).collect()) == [(1, 1, 1.0), (2, 1, 1.0)]


def test_exact_deviations_and_large_entries(spark):
    x = np.array([[2 ** 40, 3], [5, 2 ** 41], [7, 7]])
    assert W._deviation(x, 10 ** 6, (1, 1)) == [None, None, (7 * 10 ** 6 - 1) ** 2 * 2]
    big = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.25, 0.0]), (3, [-0.0, 1.0])], "vec_id long, embedding array<double>")
    assert big.where(W.usable("embedding")).count() == 2
    assert [r[0] for r in big.where("vec_id = 3").select(W.quantised("embedding")).collect()] == [[0, 256]]
    assert W.fit(big).n == 2 and F is not None


def test_triangular_solve_and_factor():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(50, 5))
    r = W.factor(a.T @ a, 50, shift=False)
    assert np.allclose(r, np.triu(r)) and np.allclose(W.solve(a, r) @ r, a) and np.allclose(W.solve(a, r).T @ W.solve(a, r), np.eye(5))
    g = np.ones((3, 3))
    assert np.allclose(W.factor(g, 10, shift=True).T @ W.factor(g, 10, shift=True), g, atol=1e-6)
