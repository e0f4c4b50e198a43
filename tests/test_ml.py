"""Metrics against MLlib's evaluators, model properties, sampling determinism, score sinks."""

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.evaluation import BinaryClassificationMetrics
from pyspark.sql import functions as F

from airmesh.operators import classify, cluster, metrics, sampling
from airmesh.plans import learning
from airmesh.sources import scores, standins

from .conftest import SF_ORACLE, SF_SMALL


@pytest.fixture(scope="module")
def rb(spark):
    return learning.rule_based(spark, SF_ORACLE).cache()


def test_f1_and_accuracy_equal_mllib(rb):
    f1 = metrics.weighted_f1(rb).first()[0]
    acc = metrics.accuracy(rb).first()[0]
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert f1 == pytest.approx(ev.setMetricName("f1").evaluate(rb), abs=1e-12)
    assert acc == pytest.approx(ev.setMetricName("accuracy").evaluate(rb), abs=1e-12)
    assert round(f1, 6) == 0.337378 and round(acc, 6) == 0.337383


def test_auc_equals_binary_metrics(rb):
    ovr = metrics.ovr_scores(rb, "scores", "label")
    got = {r["class"]: r.auc for r in metrics.roc_auc(ovr).collect()}
    for c in range(3):
        pairs = ovr.filter(F.col("class") == c).select("score", "positive").rdd.map(tuple)
        assert got[c] == pytest.approx(BinaryClassificationMetrics(pairs).areaUnderROC, abs=1e-9)
    assert [round(got[c], 6) for c in range(3)] == [0.496813, 0.499277, 0.500931]


def test_roc_curve_endpoints(rb):
    ovr = metrics.ovr_scores(rb, "scores", "label")
    pts = metrics.roc_points(ovr).filter(F.col("class") == 0).collect()
    coords = {(p.fpr, p.tpr) for p in pts}
    assert (0.0, 0.0) in coords and (1.0, 1.0) in coords
    assert all(0.0 <= p.fpr <= 1.0 and 0.0 <= p.tpr <= 1.0 for p in pts)


def test_silhouette_equals_clustering_evaluator(rb):
    cols = ["l_quantity", "l_discount", "l_tax"]
    got = metrics.silhouette(rb, cols, "cluster").first()[0]
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(rb)
    want = ClusteringEvaluator(predictionCol="cluster").evaluate(vec)
    assert got == pytest.approx(want, abs=1e-9)


def test_silhouette_single_cluster_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (2.0, 3.0, 0.0)], "a double, b double, c double")
    assert metrics.silhouette(df, ["a", "b"], "c").first()[0] is None


def test_split_and_folds_are_layout_independent(spark):
    li = standins.table(spark, SF_ORACLE, "lineitem").select("l_orderkey")
    a = li.filter(sampling.is_train("l_orderkey")).count()
    b = li.repartition(13).filter(sampling.is_train("l_orderkey")).count()
    assert a == b and 0.69 < a / li.count() < 0.71
    folds = li.filter(sampling.is_train("l_orderkey")).groupBy(sampling.fold_of("l_orderkey").alias("f")).count()
    sizes = sorted(r["count"] for r in folds.collect())
    assert len(sizes) == 5 and sizes[-1] - sizes[0] < 0.1 * sizes[-1]


def test_split_hash_has_no_overflow_for_large_keys(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000,), (123,)], "k long")
    assert df.select(sampling.split_hash("k"), sampling.fold_of("k")).count() == 2


def test_split_holds_for_every_residue_and_fold(spark):
    keys = spark.range(100_000).select(F.col("id"), sampling.is_train("id").cast("double").alias("t"), sampling.fold_of("id").alias("f"),
                                       (sampling.unit_hash("id") < 0.1).alias("s"))
    for n in (2, 3, 5, 7, 10):
        assert all(0.69 < r.t < 0.71 for r in keys.groupBy(F.col("id") % n).agg(F.avg("t").alias("t")).collect())
    assert all(0.69 < r.t < 0.71 for r in keys.groupBy("f").agg(F.avg("t").alias("t")).collect())
    assert all(0.68 < r.t < 0.72 for r in keys.groupBy("s").agg(F.avg("t").alias("t")).collect())


def test_sample_is_exact_and_stays_spread(spark):
    df = spark.range(50_000).select(F.col("id"), (F.col("id") % 9).alias("x")).repartition(6)
    got = sampling.sample_to_target(df, "id", 7_000)
    rows = [r.id for r in got.collect()]
    fraction = 7_000 / 50_000
    want = df.filter(sampling.unit_hash("id") < fraction).orderBy(sampling.unit_hash("id"), "id").limit(7_000)
    assert sorted(rows) == sorted(r.id for r in want.collect())
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    repeated = spark.range(1000).select(F.lit(5).cast("long").alias("id"))  # one key holds all rows
    assert sampling.sample_to_target(repeated, "id", 10).count() in (0, 10)
    assert sampling.sample_to_target(df, "id", 0).count() == 0


def test_undefined_curves_are_null(spark):
    df = spark.createDataFrame([(0, 0.5, 1.0), (0, 0.25, 1.0), (1, 0.5, 0.0), (2, 0.5, 1.0), (2, 0.1, 0.0)], "class int, score double, positive double")
    auc = {r["class"]: r.auc for r in metrics.roc_auc(df).collect()}
    assert auc == {0: None, 1: None, 2: 1.0}
    points = metrics.roc_points(df).filter("threshold is not null").collect()
    assert all(p.fpr is None for p in points if p["class"] == 0) and all(p.tpr is None for p in points if p["class"] == 1)


def test_skewed_scores_stay_exact(spark):
    import random

    rnd = random.Random(11)
    df = spark.createDataFrame([(0, rnd.random() ** 8, float(rnd.random() < 0.4)) for _ in range(5000)], "class int, score double, positive double")
    run_pos = run_neg = 0.0
    for r in metrics._score_groups(df).orderBy(F.desc("score")).collect():
        run_pos, run_neg = run_pos + r.pos, run_neg + r.neg
        assert (r.cum_pos, r.cum_neg) == (run_pos, run_neg)


def test_silhouette_of_a_single_point_cluster(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame([(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.5, 0.5, 0.0), (9.0, 9.0, 1.0)], "x double, y double, prediction double")
    got = metrics.silhouette(df, ["x", "y"]).first().silhouette
    assert got == pytest.approx(ClusteringEvaluator().evaluate(VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)))


def test_a_label_that_a_fold_lacks_is_an_error_not_a_failure(spark):
    s = standins.sensor(spark, SF_SMALL)
    rare = s.withColumn("Workout", F.when(F.col("id") == 7, "rare").otherwise(F.col("Workout")))
    scores_ = classify.cross_validate(classify.logistic_grid()[:1], rare, folds=3).collect()
    assert len(scores_) == 3


def test_sample_to_target_caps_rows(spark):
    s = standins.sensor(spark, SF_SMALL)
    total = s.count()
    got = sampling.sample_to_target(s, "id", target=total // 2)
    n = got.count()
    assert n <= total // 2 and n > 0
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in sampling.sample_to_target(s, "id", total // 2).collect())


def test_logistic_regression_properties(spark):
    s = standins.sensor(spark, SF_SMALL)
    train, test = sampling.train_test_split(s, "id")
    grid = classify.logistic_grid()[:1]
    preds = classify.train_and_predict(grid, train, test).collect()
    assert len(preds) == test.count()
    for r in preds:
        assert sum(r.probability) == pytest.approx(1.0, abs=1e-9)
        assert r.prediction == max(range(len(r.probability)), key=lambda i: r.probability[i])


def test_cross_validation_scores_shape(spark):
    s = standins.sensor(spark, SF_SMALL)
    train, _ = sampling.train_test_split(s, "id")
    grid = classify.forest_grid()[:1]
    sc = classify.cross_validate(grid, train, folds=3)
    rows = sc.collect()
    assert len(rows) == 3 and all(0.0 <= r.f1 <= 1.0 and 0.0 <= r.accuracy <= 1.0 for r in rows)
    best = classify.best_scores(sc).first()
    assert best.model == "forest"


def test_held_out_folds_are_whole_above_the_sample_target(spark, monkeypatch):
    """Only fitted rows are bounded: n_rows of each fold is what the query's SQL counts."""
    import duckdb

    from airmesh.plans.registry import ORACLE_SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    want = {(r[3], r[4]) for r in con.execute(ORACLE_SQL["cv_scores"]).fetchall()}
    seen, fit = [], classify.fit
    monkeypatch.setattr(classify, "fit", lambda c, rows: seen.append(rows.count()) or fit(c, rows))
    monkeypatch.setattr(learning, "_GRID", classify.logistic_grid()[:1])
    for f in (classify.cross_validate, sampling.sample_to_target):
        monkeypatch.setattr(f, "__defaults__", (*f.__defaults__[:-1], 100))
    got = learning.q_cv_scores(spark, SF_SMALL).collect()
    assert {(r.fold, r.n_rows) for r in got} == want and sum(r.n_rows for r in got) > 100
    assert seen and max(seen) <= 100


def test_kmeans_sweep_assigns_nearest_centre(spark):
    s = standins.sensor(spark, SF_SMALL)
    train, test = sampling.train_test_split(s, "id")
    board = cluster.sweep("kmeans", train, test, ks=(2, 3)).orderBy("k").collect()
    assert [r.k for r in board] == [2, 3]
    assert all(r.silhouette is None or -1.0 <= r.silhouette <= 1.0 for r in board)


def test_score_sink_latest_run_wins(spark, tmp_dir):
    path = f"{tmp_dir}/scores"
    first = spark.createDataFrame([("kmeans", 2, 0.1), ("kmeans", 3, 0.2)], "model string, k int, silhouette double")
    second = spark.createDataFrame([("kmeans", 2, 0.5)], "model string, k int, silhouette double")
    scores.write_scores(first, path, run_id="a")
    import time
    time.sleep(1.1)
    scores.write_scores(second, path, run_id="b")
    got = [(r.k, r.silhouette) for r in scores.read_latest_scores(spark, path).collect()]
    assert got == [(2, 0.5), (3, 0.2)]


def test_curve_sink_partitions_by_class(spark, tmp_dir, rb):
    ovr = metrics.ovr_scores(rb, "scores", "label")
    path = f"{tmp_dir}/roc"
    scores.write_curves(metrics.roc_points(ovr), path)
    back = spark.read.parquet(path)
    assert sorted(r["class"] for r in back.select("class").distinct().collect()) == [0, 1, 2]


def test_auc_two_level_prefix_sum_with_many_distinct_scores(spark):
    import random

    rnd = random.Random(7)
    rows = [(rnd.random() ** 2, float(rnd.random() < 0.3)) for _ in range(3000)] + [(0.5, 1.0), (0.5, 0.0)] * 20
    df = spark.createDataFrame([(0, s, p) for s, p in rows], "class int, score double, positive double")
    g = metrics._score_groups(df).orderBy(F.desc("score")).collect()
    run_pos = run_neg = 0.0
    for r in g:  # cumulative counts equal a plain running sum over descending scores
        run_pos += r.pos
        run_neg += r.neg
        assert (r.cum_pos, r.cum_neg) == (run_pos, run_neg)
    got = metrics.roc_auc(df).first().auc
    # exact pairwise AUC (MLlib's class bins above 1000 distinct scores, so it is only approximate here)
    import bisect

    neg = sorted(s for s, p in rows if p == 0.0)
    pos = [s for s, p in rows if p == 1.0]
    pairs = sum(bisect.bisect_left(neg, s) + 0.5 * (bisect.bisect_right(neg, s) - bisect.bisect_left(neg, s))
                for s in pos)
    assert got == pytest.approx(pairs / (len(pos) * len(neg)), abs=1e-12)


def test_model_auc_equals_binary_metrics(spark):
    s = standins.sensor(spark, SF_SMALL)
    train, test = sampling.train_test_split(s, "id")
    preds = classify.train_and_predict(classify.logistic_grid()[:1], train, test).cache()
    ovr = metrics.ovr_scores(preds, "probability", "label").cache()
    got = {r["class"]: r.auc for r in metrics.roc_auc(ovr).collect()}
    for c in sorted(got)[:3]:
        pairs = ovr.filter(F.col("class") == c).select("score", "positive").rdd.map(tuple)
        assert got[c] == pytest.approx(BinaryClassificationMetrics(pairs).areaUnderROC, abs=1e-9)
