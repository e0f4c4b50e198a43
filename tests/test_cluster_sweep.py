"""All k of a sweep are fitted in shared scans: as well as one by one, with scans that don't grow with the number of k."""

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.sql import functions as F

from airmesh.operators import cluster, features, metrics, sampling
from airmesh.sources import standins
from airmesh.sources.schemas import SENSOR_GYRO

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def halves(spark):
    return sampling.train_test_split(standins.sensor(spark, SF_SMALL), "id")


def _scans(monkeypatch, run):
    calls, scan = [], cluster.summed
    monkeypatch.setattr(cluster, "summed", lambda *a: calls.append(1) or scan(*a))
    out = run()
    monkeypatch.setattr(cluster, "summed", scan)
    return len(calls), out


def test_scans_do_not_grow_with_the_number_of_k(halves, monkeypatch):
    rows = cluster.vectors(halves[0], SENSOR_GYRO).cache()
    n_one, one = _scans(monkeypatch, lambda: cluster.kmeans_all(rows, (11,)))
    n_all, all_ = _scans(monkeypatch, lambda: cluster.kmeans_all(rows, cluster.K_RANGE))
    most = cluster.DRAWS + 3 + cluster.KMEANS_ROUNDS
    assert n_one <= most and n_all <= most
    # the same centres, whether other k are fitted along or not
    assert np.allclose(one[0][11], all_[0][11]) and sorted(all_[0]) == list(cluster.K_RANGE)


def test_fits_are_as_good_as_separate_ones(halves):
    rows = cluster.vectors(halves[0], SENSOR_GYRO).cache()
    assembled = features.assemble(halves[0], SENSOR_GYRO).select(features.FEATURES).cache()
    n = rows.count()
    _, cost = cluster.kmeans_all(rows, (2, 5, 9))
    _, likelihood = cluster.mixture_all(rows, (2, 5, 9))
    for k in (2, 5, 9):
        km = KMeans(k=k, seed=1, featuresCol=features.FEATURES).fit(assembled)
        gm = GaussianMixture(k=k, seed=1, featuresCol=features.FEATURES).fit(assembled)
        assert cost[k] <= 1.05 * km.summary.trainingCost / n
        assert likelihood[k] >= gm.summary.logLikelihood / n - 0.01 * abs(gm.summary.logLikelihood / n)
        assert likelihood[k] > likelihood[1] and cost[k] < cost[1]


def test_known_clusters_are_found(spark):
    random = np.random.default_rng(2)
    middles = np.array([[0, 0], [10, 0], [0, 10.0]])
    points = np.concatenate([m + random.normal(0, s, (200, 2)) for m, s in zip(middles, (0.5, 1.0, 2.0))])
    rows = spark.createDataFrame([(x.tolist(),) for x in points], "x array<double>").repartition(5)
    centres, _ = cluster.kmeans_all(rows, (2, 3, 4))
    assert np.abs(centres[3][np.lexsort(centres[3].round(0).T)] - middles[np.lexsort(middles.T)]).max() < 0.5
    shares, means, covariances = cluster.mixture_all(rows, (3,))[0][3]
    for middle, s in zip(middles, (0.5, 1.0, 2.0)):
        own = int(((means - middle) ** 2).sum(1).argmin())
        assert np.allclose(means[own], middle, atol=0.5) and abs(shares[own] - 1 / 3) < 0.02
        assert np.allclose(covariances[own], s * s * np.eye(2), atol=0.3 * s * s + 0.05)


def test_silhouettes_equal_the_operator(spark, halves):
    rows = cluster.vectors(halves[1], SENSOR_GYRO).cache()
    centres, _ = cluster.kmeans_all(rows, (2, 4))
    got = cluster.silhouettes(rows, cluster._placers("kmeans", centres), {2: 2, 4: 4})
    for k, c in centres.items():
        far = F.array(*[sum(((F.col("x")[i] - float(v)) ** 2 for i, v in enumerate(m)), F.lit(0.0)) for m in c])
        placed = rows.withColumn("prediction", F.array_position(far, F.array_min(far)).cast("int"))
        assert got[k][0] == pytest.approx(metrics.silhouette(placed, "x").first()[0], abs=1e-9)
        assert got[k][1:] == (rows.count(), 0)


def test_odd_rows(spark):
    columns = ("a", "b")
    same = spark.createDataFrame([(1.0, 2.0)] * 9, "a double, b double")
    for model in ("kmeans", "gmm"):
        board = cluster.sweep(model, same, same, columns, (2, 3)).orderBy("k").collect()
        assert [(r.k, r.silhouette, r.n_rows, r.n_misplaced) for r in board] == [(2, None, 9, 0), (3, None, 9, 0)]
        assert cluster.sweep(model, same.filter("a < 0"), same, columns, (2,)).count() == 0
        none_placed = cluster.sweep(model, same, same.filter("a < 0"), columns, (2,)).first()
        assert (none_placed.silhouette, none_placed.n_rows) == (None, 0)
    holes = same.unionByName(spark.createDataFrame([(None, 1.0), (float("nan"), 1.0), (1.0, float("inf")), (5.0, 5.0)], "a double, b double"))
    row = cluster.sweep("kmeans", holes, holes, columns, (2,)).first()
    assert row.n_rows == 10 and row.fit == 0.0 < row.fit_of_one
