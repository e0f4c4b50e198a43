import numpy as np
import pytest
from pyspark.sql import functions as F

from airmesh.llm import whitening as w
from airmesh.llm.queries import op13_whitening

from ..conftest import SF_ORACLE


def plain(rows, leading=16):
    """(kept, n, deviation by row, whitened by row, explained) through numpy's own eigenvectors."""
    kept = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64) + 1_000_000) for i, v in rows
            if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:leading]
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(x, sums)) for _, x in kept]
    white = [(x - sums / n) @ vectors[:, order] / np.sqrt(values[order]) for _, x in kept]
    return kept, n, deviation, white, values[order] / values.sum()


def held(result):
    out = {}
    for r in result.collect():
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def test_equals_dense_eigenvectors(spark):
    table = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet")
    got = held(op13_whitening(spark, SF_ORACLE))
    kept, n, deviation, white, explained = plain([(r.vec_id, r.embedding) for r in table.collect()])
    assert len(got) == len(kept)
    matrix = np.array([[got[i][c].whitened for c in range(1, 17)] for i, _ in kept])
    sign = np.sign((matrix * np.array(white)).sum(0))  # one for all rows of a component
    assert np.abs(matrix * sign - np.array(white)).max() < 1e-9
    for (i, _), d in zip(kept, deviation, strict=True):
        assert all(r.n == n and r.deviation == d and abs(r.identity_error) <= 1e-9 for r in got[i].values())
    assert np.allclose([got[kept[0][0]][c].explained for c in range(1, 17)], explained, rtol=1e-9)


@pytest.mark.parametrize("spectrum", [[9, 8, 7, 6, 5, 4, 3, 2, 1, 0.5], [4, 4, 4, 4, 4, 4, 4, 1, 1, 1], [1e6, 1e6 * (1 - 1e-9), 5, 5 - 1e-7, 1e-3, 1e-5, 0, 0, 0, 0], [3] + [0] * 9, [1] * 10])
@pytest.mark.parametrize("leading", [1, 3, 8, 16])
def test_pairs_of_known_spectra(spark, spectrum, leading):
    q = np.linalg.qr(np.random.default_rng(4).standard_normal((10, 10)))[0]
    matrix = q @ np.diag(spectrum) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = w.leading_pairs(spark, matrix, leading)
    positive = [v for v in sorted(spectrum, reverse=True) if v > 1e-11 * max(spectrum)][:leading]
    assert np.allclose(values, positive, rtol=1e-10, atol=1e-11 * max(spectrum))
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() <= 1e-11 * max(spectrum)


def test_inertia_counts_eigenvalues():
    random = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 20):
        for _ in range(20):
            a = random.standard_normal((n, n))
            a = a + a.T
            if n > 2:
                a[np.arange(n), np.arange(n)] = 0  # pivots of two rows
            values = np.linalg.eigvalsh(a)
            for t in (-1.0, 0.0, 0.3, 2.0):
                assert w.count_above(a, t) == (values > t).sum()


def test_a_subspace_too_small_is_noticed(spark):
    """Intervals part the spectrum: each holds few eigenvalues, and all counts add up."""
    matrix = np.diag([9.0, 8, 7, 6, 5, 4, 3, 2, 1, 0.5])
    parts = w.intervals(matrix, 6)
    assert sum(n for *_, n in parts) == 6 and all(n <= w.PER_INTERVAL for *_, n in parts)
    assert all(n == sum(low < v < high for v in np.diag(matrix)) for low, high, n in parts)


def test_odd_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0, -2.0]), (2, [0.5, 1.0, -2.0]), (None, [1.5, 0.0, 0.25]), (3, None), (4, []), (5, [1.0, None, 2.0]), (6, [nan, 1.0, 1.0]),
            (7, [inf, 0.0, 0.0]), (8, [-inf, 0.0, 0.0]), (9, [1.0, 2.0]), (10, [-3.5, 7.0, 0.0]), (10, [-3.5, 7.0, 0.0]), (11, [2.0, -9.0, 4.0])]
    table = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<float>, x int, component string")
    got = w.whiten(table).collect()
    kept, n, deviation, white, _ = plain([r for r in rows if r[1] is None or len(r[1]) == 3])
    assert n == 4 and len(got) == 3 * len(kept)
    assert sorted((r.vec_id or 0, r.deviation) for r in got if r.component == 1) == sorted((i or 0, d) for (i, _), d in zip(kept, deviation))
    assert max(abs(r.identity_error) for r in got) < 1e-10
    assert sorted(abs(r.whitened) for r in got if r.component == 2) == pytest.approx(sorted(abs(x[1]) for x in white))
    assert w.whiten(table.filter("false")).count() == 0
    assert w.whiten(table.filter("vec_id = 1")).count() == 0  # no variance, no component
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id int, embedding array<double>")
    assert w.whiten(flat).filter("component > 1").count() == 0 and w.whiten(flat).count() == 5


def test_deviations_beyond_64_bits():
    fit = w.Fit(3_000_000_000, np.array([3_000_000_000 * 5, 1]), np.zeros(0), np.zeros((0, 2)), 0.0)
    assert fit.deviations(np.array([[5, 0], [6, 0], [9, 0]])) == [1, 9 * 10 ** 18 + 1, None]
