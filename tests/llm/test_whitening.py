from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from replaystats.llm import whitening as wt

SCHEMA = "vec_id long, embedding array<float>, label int, w string, n long, i int"


def table(spark, data, schema=SCHEMA):
    """Vectors with columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, v, 0, "x", 1, 1) for i, v in data], schema)


def integers(vectors) -> np.ndarray:
    return np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], dtype=np.int64)


def by_numpy(x: np.ndarray, k: int):
    """Components by the library's own solver over an exact covariance."""
    n, d = x.shape
    sums = [int(s) for s in x.sum(0)]
    centred = [[Fraction(int(v) * n - s, n) for v, s in zip(row, sums, strict=True)] for row in x]
    cov = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    return cov, e, (x - np.array(sums) / n) @ u[:, :k] / np.sqrt(e[:k])


def vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) @ np.diag(np.linspace(2, 0.5, d))).astype(np.float32).tolist()


def test_against_numpy(spark):
    data = vectors(200, 12)
    got = wt.whiten(table(spark, list(enumerate(data)))).collect()
    x = integers(data)
    cov, e, want = by_numpy(x, 8)
    w = np.zeros((200, 8))
    for r in got:
        w[r.vec_id, r.component - 1] = r.whitened
        assert r.explained == pytest.approx(e[r.component - 1] / np.trace(cov), rel=1e-9)
    assert len(got) == 1600 and {r.n for r in got} == {200}
    sign = np.sign((w * want).sum(0))
    assert np.abs(w * sign - want).max() < 1e-10
    assert all(r.identity_error < 1e-9 for r in got)
    deviations = {r.vec_id: int(r.deviation) for r in got}
    sums = x.sum(0)
    assert all(deviations[i] == sum((200 * int(v) - int(s)) ** 2 for v, s in zip(x[i], sums, strict=True)) for i in range(200))


def test_rows_that_do_not_count(spark):
    good = vectors(30, 3)
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 1.0, 2.0]), (103, [float("inf"), 0.0, 0.0]), (104, []), (105, [1.0, 2.0])]
    bad += [(106, [3e38, 0.0, 0.0])]
    data = [*enumerate(good), *bad, (None, good[0]), (1, good[1])]
    got = wt.whiten(table(spark, data)).collect()
    assert sorted({r.vec_id for r in got if r.vec_id is not None}) == list(range(30))
    assert {r.n for r in got} == {32} and len(got) == 32 * 3  # three dimensions, three components
    assert sum(r.vec_id is None for r in got) == 3


def test_double_entries_and_few_rows(spark):
    data = table(spark, [(1, [1.0, 2.0, 4.0]), (2, [2.0, 2.0, 4.5])], SCHEMA.replace("float", "double"))
    got = {(r.vec_id, r.component): r for r in wt.whiten(data).collect()}
    assert abs(got[1, 1].whitened) == pytest.approx(1) and got[1, 1].explained == pytest.approx(1)
    assert got[1, 2].whitened is None and got[1, 3].whitened is None  # no variance left
    assert got[1, 1].identity_error < 1e-9


def test_nothing_to_scale(spark):
    same = [r for r in wt.whiten(table(spark, [(i, [0.5, 0.25]) for i in range(4)])).collect()]
    assert len(same) == 8 and all(r.whitened is None and r.identity_error is None and r.deviation == 0 for r in same)
    assert wt.whiten(table(spark, [])).count() == 0
    assert wt.whiten(table(spark, [(1, None), (2, [])])).count() == 0


def test_deviation_beyond_a_long(spark):
    big = [(1, [float(1 << 40)]), (2, [0.0]), (3, [0.0])]
    got = {r.vec_id: int(r.deviation) for r in wt.whiten(table(spark, big)).collect()}
    x = [(1 << 50) + 100_000, 100_000, 100_000]
    assert got == {i + 1: (3 * v - sum(x)) ** 2 for i, v in enumerate(x)}


@pytest.mark.parametrize(
    "values",
    [
        [5, 5, 5, 3, 3, 1, 1e-3, 1e-6],
        [1, 1 + 1e-9, 1 - 1e-9, 0.5, 0.5, 0.1],
        [1, 1 + 1e-13, 0.3, 0.3 + 1e-12, 0, 0],
        [1] * 6,
        [3],
        [0, 0],
        list(1 + np.arange(40) * 1e-6),  # one cluster for single precision
    ],
)
def test_clustered_eigenvalues(values):
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(len(values),) * 2))
    a = (q * np.array(values, dtype=float)) @ q.T
    a = (a + a.T) / 2
    e, x = wt.refined_eigenvectors(a)
    size = max(max(values), 1e-300)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-14
    assert np.abs(a @ x - x * e).max() < 4e-15 * size
    assert np.abs(e - np.sort(values)[::-1]).max() < 4e-15 * size


def test_separated_components_are_those_of_extended_precision():
    """A start in single precision alone is wrong from the seventh digit on."""
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(16, 16)))
    a = (q * np.linspace(1, 2, 16)) @ q.T
    a = (a + a.T) / 2
    e, x = wt.refined_eigenvectors(a)
    _, rough = np.linalg.eigh(a.astype(np.float32))
    rough = rough[:, ::-1] * np.sign((rough[:, ::-1] * x).sum(0))
    _, good = np.linalg.eigh(a)
    good = good[:, ::-1] * np.sign((good[:, ::-1] * x).sum(0))
    assert np.abs(x - good).max() < 1e-13 < 1e-8 < np.abs(x - rough).max()


def test_products_of_slices_are_extended():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(30, 50)).astype(np.longdouble), rng.normal(size=(50, 20)).astype(np.longdouble)
    assert np.abs(wt.product(a, b) - a @ b).max() < 1e-16
