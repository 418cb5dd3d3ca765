"""Whitening against an eigendecomposition of the exact covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as entry
from qcmart.llm import whitening

COLUMNS = "vec_id long, embedding array<double>, x string, n int, component int"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0, 1) for i, v in rows], COLUMNS)


def _whole(v):
    return [math.floor(64 * c) + 1_000_000 for c in v]


def _run(spark, tmp_path, rows):
    path = f"{tmp_path}/{len(list(tmp_path.iterdir()))}"
    _table(spark, rows).write.parquet(f"{path}/embeddings.parquet")
    return entry.queries()["op13_embedding_whitening"](spark, path).collect()


@pytest.mark.parametrize("n,d", [(400, 6), (60, 20), (9, 12)])
def test_whitening_matches_eigenvectors(spark, tmp_path, n, d):
    random = np.random.default_rng(n)
    points = random.normal(size=(n, d)) @ np.diag(np.linspace(1, 9, d)) + 1e4
    rows = [(i, [float(c) for c in p]) for i, p in enumerate(points)]
    rows += [(1000 + k, rows[0][1]) for k in range(7)] + [(3, rows[4][1]), (None, rows[5][1])]
    odd = [(-1, None), (-2, []), (-3, [1.0, None] + [1.0] * (d - 2)), (-4, [math.nan] * d), (-5, [math.inf] * d), (-6, [2.0**46] * d)]
    got = _run(spark, tmp_path, rows + odd)

    x = np.array([_whole(v) for _, v in rows], object)
    fit = np.array(sorted({tuple(v) for v in x}), object)
    sums, m = fit.sum(axis=0), len(fit)
    centred = np.array([[float(Fraction(int(m * c - s), m)) for c, s in zip(v, sums, strict=True)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / m)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(16, d, m - 1)
    expected = np.array([[float(Fraction(int(m * c - s), m)) for c, s in zip(v, sums, strict=True)] for v in x])
    expected = expected @ vectors[:, :k] / np.sqrt(values[:k])
    deviations = [int(((m * v - sums) ** 2).sum()) for v in x]

    assert len(got) == len(rows) * k
    assert {r.n for r in got} == {m} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    for c in range(1, k + 1):
        mine = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, r.whitened) for r in got if r.component == c)
        true = sorted(
            (i is None, i or 0, dev, w) for (i, _), dev, w in zip(rows, deviations, expected[:, c - 1], strict=True)
        )
        assert [t[:3] for t in mine] == [t[:3] for t in true]
        a, b = np.array([t[3] for t in mine]), np.array([t[3] for t in true])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        share = {r.explained for r in got if r.component == c}
        assert len(share) == 1 and abs(share.pop() - values[c - 1] / values.sum()) < 1e-10


def test_too_little_to_whiten(spark, tmp_path):
    assert _run(spark, tmp_path, [(1, None)]) == []
    assert _run(spark, tmp_path, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert _run(spark, tmp_path, [(1, []), (2, [])]) == []
    two = _run(spark, tmp_path, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 12))) for r in two) == [(1, 1, 1.0), (2, 1, 1.0)]


def test_large_deviations_stay_exact(spark):
    rows = _table(spark, [(1, [0.0, 0.0]), (2, [2.0**40, 0.0]), (3, [0.0, 2.0**40]), (4, [1.0, 0.0])])
    rows = whitening.whole(rows)
    got = {r.vec_id: int(r.deviation) for r in whitening.whitened(rows, whitening.fitted(rows)).collect()}
    x = [(0, 0), (2**46, 0), (0, 2**46), (64, 0)]
    s = [sum(v[k] for v in x) for k in (0, 1)]
    assert got == {i + 1: sum((4 * c - t) ** 2 for c, t in zip(v, s, strict=True)) for i, v in enumerate(x)}


def test_factors_by_themselves():
    random = np.random.default_rng(0)
    a = random.normal(size=(7, 40))
    a[6] = a[0] + a[1]
    scatter = a @ a.T
    factor, order = whitening.pivoted_cholesky(scatter)
    assert factor.shape == (7, 6)
    assert np.allclose(factor @ factor.T, scatter[np.ix_(order, order)])
    assert np.allclose(np.triu(factor[:6], 1), 0)
    columns = whitening.orthogonal_columns(factor)
    assert np.allclose(columns @ columns.T, factor @ factor.T)
    both = columns.T @ columns
    assert np.allclose(both, np.diag(np.diag(both)))
    for n in (1, 2, 5, 8):
        met = [frozenset(map(int, pair)) for p, q in whitening.rounds(n) for pair in zip(p, q, strict=True)]
        assert len(met) == len(set(met)) == n * (n - 1) // 2
