"""Sensor-ML queries: load, sample, split, features, models, metrics.

Metric queries use rule-based labels / predictions / scores over ``lineitem``
(no trained model) so DuckDB can check them exactly; trained-model queries
return what SQL can state of them: the rows that they score and what must hold
for each.  The fitted values are the operators' results; tests check them.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import classify, cluster, features, metrics, sampling
from ..session import cut_lineage, fresh_folder
from ..sources import delimited, scores, standins
from ..sources.schemas import SENSOR_COLUMNS, SENSOR_NUMERIC
from .registry import query
from .sqltext import SENSOR, with_ctes

# ---------------------------------------------------------------- rule-based inputs over lineitem
_RB = """rb AS (
  SELECT l_orderkey, l_linenumber,
         CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS DOUBLE) AS label,
         CAST(l_partkey % 3 AS DOUBLE) AS prediction,
         l_quantity / 50 AS s0, l_discount * 10 AS s1, l_tax * 12 AS s2,
         CAST(l_linenumber % 4 AS DOUBLE) AS cluster, l_quantity, l_discount, l_tax
  FROM lineitem)"""
_OVR = """ovr AS (
  SELECT l_orderkey, l_linenumber, 0 AS class, s0 AS score, CAST(CASE WHEN label = 0 THEN 1 ELSE 0 END AS DOUBLE) AS positive FROM rb
  UNION ALL
  SELECT l_orderkey, l_linenumber, 1, s1, CAST(CASE WHEN label = 1 THEN 1 ELSE 0 END AS DOUBLE) FROM rb
  UNION ALL
  SELECT l_orderkey, l_linenumber, 2, s2, CAST(CASE WHEN label = 2 THEN 1 ELSE 0 END AS DOUBLE) FROM rb)"""
_GROUPS = """g0 AS (SELECT class, score, sum(positive) AS pos, sum(1.0 - positive) AS neg FROM ovr GROUP BY class, score),
g AS (SELECT *, sum(pos) OVER (PARTITION BY class ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
             sum(neg) OVER (PARTITION BY class ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
             sum(pos) OVER (PARTITION BY class) AS P, sum(neg) OVER (PARTITION BY class) AS N FROM g0)"""

RETURN_FLAGS = ("A", "N", "R")


def rule_based(spark, sf_dir):
    li = standins.table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    label = F.when(flag == RETURN_FLAGS[0], 0.0).when(flag == RETURN_FLAGS[1], 1.0).when(flag == RETURN_FLAGS[2], 2.0)
    return li.select(
        "l_orderkey", "l_linenumber", label.alias("label"),
        (F.col("l_partkey") % 3).cast("double").alias("prediction"),
        F.array(F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 12).alias("scores"),
        (F.col("l_linenumber") % 4).cast("double").alias("cluster"),
        "l_quantity", "l_discount", "l_tax",
    )


@query("confusion_matrix", with_ctes(_RB, body="SELECT label, prediction, count(*) AS n FROM rb GROUP BY label, prediction"))
def q_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(rule_based(spark, sf_dir))


@query("accuracy", with_ctes(_RB, body="""SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6)
AS accuracy FROM rb"""))
def q_accuracy(spark, sf_dir):
    return metrics.accuracy(rule_based(spark, sf_dir)).select(F.round("accuracy", 6).alias("accuracy"))


@query("f1_score", with_ctes(_RB, """cm AS (SELECT label, prediction, count(*) AS n FROM rb GROUP BY label, prediction),
bl AS (SELECT label AS c, sum(n) AS n_c, sum(CASE WHEN label = prediction THEN n END) AS tp FROM cm GROUP BY label),
bp AS (SELECT prediction AS c, sum(n) AS pred_c FROM cm GROUP BY prediction)""",
    body="""SELECT round(sum(n_c * (2.0 * coalesce(tp, 0) / (n_c + coalesce(pred_c, 0)))) / sum(n_c), 6) AS f1
FROM bl LEFT JOIN bp USING (c)"""))
def q_f1_score(spark, sf_dir):
    return metrics.weighted_f1(rule_based(spark, sf_dir)).select(F.round("f1", 6).alias("f1"))


@query("class_count", with_ctes(_RB, body="SELECT CAST(max(label) AS INTEGER) + 1 AS n_classes FROM rb"))
def q_class_count(spark, sf_dir):
    return rule_based(spark, sf_dir).agg((F.max("label").cast("int") + 1).alias("n_classes"))


@query("ovr_scores", with_ctes(_RB, _OVR, body="SELECT * FROM ovr"))
def q_ovr_scores(spark, sf_dir):
    return metrics.ovr_scores(rule_based(spark, sf_dir), "scores", "label", keep=("l_orderkey", "l_linenumber"))


@query("roc_points", with_ctes(_RB, _OVR, _GROUPS, body="""
SELECT class, score AS threshold, round(cum_neg / N, 9) AS fpr, round(cum_pos / P, 9) AS tpr FROM g
UNION ALL SELECT DISTINCT class, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM ovr
UNION ALL SELECT DISTINCT class, CAST(NULL AS DOUBLE), 1.0, 1.0 FROM ovr"""))
def q_roc_points(spark, sf_dir):
    ovr = metrics.ovr_scores(rule_based(spark, sf_dir), "scores", "label")
    return metrics.roc_points(ovr).select("class", "threshold", F.round("fpr", 9).alias("fpr"),
                                          F.round("tpr", 9).alias("tpr"))


@query("roc_auc", with_ctes(_RB, _OVR, _GROUPS, body="""
SELECT class, round(sum(neg * (2.0 * cum_pos - pos) / 2.0) / (first(P) * first(N)), 6) AS auc FROM g GROUP BY class"""))
def q_roc_auc(spark, sf_dir):
    ovr = metrics.ovr_scores(rule_based(spark, sf_dir), "scores", "label")
    return metrics.roc_auc(ovr).select("class", F.round("auc", 6).alias("auc"))


@query("silhouette", with_ctes(_RB, """pts AS (SELECT cluster AS c, l_quantity AS x0, l_discount AS x1, l_tax AS x2,
  l_quantity*l_quantity + l_discount*l_discount + l_tax*l_tax AS sq FROM rb),
st AS (SELECT c, count(*) AS n, sum(sq) AS sq_sum, sum(x0) AS v0, sum(x1) AS v1, sum(x2) AS v2 FROM pts GROUP BY c),
pp AS (SELECT pts.*, row_number() OVER () AS rid FROM pts),
dd AS (SELECT pp.rid, pp.c AS pc, s.c AS sc, s.n,
              pp.sq + s.sq_sum / s.n - 2.0 * (pp.x0 * s.v0 + pp.x1 * s.v1 + pp.x2 * s.v2) / s.n AS dist
       FROM pp CROSS JOIN st s),
per AS (SELECT rid, max(CASE WHEN sc = pc THEN n END) AS own_n,
               max(CASE WHEN sc = pc THEN dist * n / (n - 1) END) AS a,
               min(CASE WHEN sc <> pc THEN dist END) AS b FROM dd GROUP BY rid)""",
    body="""SELECT round(CASE WHEN (SELECT count(*) FROM st) > 1 THEN avg(CASE WHEN own_n = 1 THEN 0.0
  WHEN a < b THEN 1.0 - a / b WHEN a > b THEN b / a - 1.0 ELSE 0.0 END) END, 6) AS silhouette FROM per"""))
def q_silhouette(spark, sf_dir):
    rb = rule_based(spark, sf_dir)
    s = metrics.silhouette(rb, ["l_quantity", "l_discount", "l_tax"], "cluster")
    return s.select(F.round("silhouette", 6).alias("silhouette"))


_SPLIT = ("(((l_orderkey % 2147483647) * 1103515245 + 12345) % 2147483647) % 10 < 7")
_FOLD = ("(((((l_orderkey % 2147483647) * 69069 + 1) % 2147483647) * 7919) % 2147483647) % 5")


@query("train_test_split", f"""SELECT CASE WHEN {_SPLIT} THEN 'train' ELSE 'test' END AS split,
count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys FROM lineitem GROUP BY 1""")
def q_train_test_split(spark, sf_dir):
    li = standins.table(spark, sf_dir, "lineitem")
    flag = F.when(sampling.is_train("l_orderkey"), "train").otherwise("test")
    return li.groupBy(flag.alias("split")).agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.count_distinct("l_orderkey").alias("n_keys"))


@query("cv_folds", f"""SELECT CAST({_FOLD} AS INTEGER) AS fold, count(*) AS n_rows FROM lineitem
WHERE {_SPLIT} GROUP BY 1""")
def q_cv_folds(spark, sf_dir):
    li = standins.table(spark, sf_dir, "lineitem")
    train, _ = sampling.train_test_split(li, "l_orderkey")
    return train.groupBy(sampling.fold_of("l_orderkey").alias("fold")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("string_index", """SELECT value, CAST(row_number() OVER (ORDER BY n DESC, value) - 1 AS DOUBLE) AS idx, n
FROM (SELECT l_returnflag AS value, count(*) AS n FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1) t""")
def q_string_index(spark, sf_dir):
    return features.string_index(standins.table(spark, sf_dir, "lineitem"), "l_returnflag")


# ---------------------------------------------------------------- sensor table (M1-M8)
_SENSOR_COLS = ", ".join(name for name, _ in SENSOR_COLUMNS)


@query("scan_sensor", with_ctes(SENSOR, body=f"SELECT id, {_SENSOR_COLS} FROM sensor"))
def q_scan_sensor(spark, sf_dir):
    s = standins.sensor(spark, sf_dir)
    return s.select("id", *[F.col(n).try_cast(t).alias(n) for n, t in SENSOR_COLUMNS])


@query("csv_sensor", with_ctes(SENSOR, body=f"SELECT {_SENSOR_COLS} FROM sensor"))
def q_csv_sensor(spark, sf_dir):
    """The sensor table as a headered CSV file, read back."""
    path = fresh_folder(spark, "sensor-csv")
    delimited.write_delimited(standins.sensor(spark, sf_dir).select(*[n for n, _ in SENSOR_COLUMNS]), path, header=True)
    return delimited.read_headered(spark, path)


#: Below the row count at every scale, so that fraction and cap both act.
SAMPLED = 300
_U = "((((id % 2147483648) * 1103515245 + 12345) % 2147483648) / 2147483648.0)"


@query("sample_target", with_ctes(SENSOR, body=f"""SELECT id, {_SENSOR_COLS} FROM sensor
WHERE {_U} < least(1.0, {SAMPLED}.0 / (SELECT count(*) FROM sensor))
ORDER BY {_U}, id LIMIT {SAMPLED}"""))
def q_sample_target(spark, sf_dir):
    return sampling.sample_to_target(standins.sensor(spark, sf_dir), "id", SAMPLED)


_POS_IDX = """pidx AS (SELECT value, row_number() OVER (ORDER BY n DESC, value) - 1 AS idx
  FROM (SELECT Position AS value, count(*) AS n FROM sensor GROUP BY 1) t)"""


@query("one_hot", with_ctes(SENSOR, _POS_IDX, body="""SELECT s.id, s.Position, CAST(p.idx AS DOUBLE) AS position_idx,
  CAST(CASE WHEN p.idx = 0 THEN 1 ELSE 0 END AS DOUBLE) AS oh_0, CAST(CASE WHEN p.idx = 1 THEN 1 ELSE 0 END AS DOUBLE) AS oh_1,
  CAST(CASE WHEN p.idx = 2 THEN 1 ELSE 0 END AS DOUBLE) AS oh_2
FROM sensor s JOIN pidx p ON p.value = s.Position"""))
def q_one_hot(spark, sf_dir):
    s = standins.sensor(spark, sf_dir)
    model = Pipeline(stages=[features.indexer("Position", "position_idx"),
                             features.one_hot("position_idx", "position_vec")]).fit(s)
    out = model.transform(s).withColumn("_v", vector_to_array("position_vec"))
    width = len(model.stages[0].labels)
    return out.select("id", "Position", "position_idx", *[F.col("_v")[i].alias(f"oh_{i}") for i in range(width)])


@query("standard_scale", with_ctes(SENSOR, body="SELECT id, " + ", ".join(
    f"round({c} / (SELECT stddev_samp({c}) FROM sensor), 6) AS {c}" for c in SENSOR_NUMERIC) + " FROM sensor"))
def q_standard_scale(spark, sf_dir):
    from pyspark.ml.feature import StandardScaler
    s = features.assemble(standins.sensor(spark, sf_dir), SENSOR_NUMERIC, "numeric_vec")
    scaled = StandardScaler(inputCol="numeric_vec", outputCol="scaled", withStd=True, withMean=False).fit(s).transform(s)
    arr = vector_to_array("scaled")
    return scaled.select("id", *[F.round(arr[i], 6).alias(c) for i, c in enumerate(SENSOR_NUMERIC)])


_TRAIN = "((((id % 2147483647) * 1103515245 + 12345) % 2147483647) % 10 < 7)"


@query("feature_vectors", with_ctes(
    SENSOR,
    f"""tr AS (SELECT * FROM sensor WHERE {_TRAIN}),
pidx AS (SELECT value, row_number() OVER (ORDER BY n DESC, value) - 1 AS idx
  FROM (SELECT Position AS value, count(*) AS n FROM tr GROUP BY 1) t),
lidx AS (SELECT value, row_number() OVER (ORDER BY n DESC, value) - 1 AS idx
  FROM (SELECT Workout AS value, count(*) AS n FROM sensor GROUP BY 1) t),
sd AS (SELECT {', '.join(f'stddev_samp({c}) AS {c}' for c in SENSOR_NUMERIC)} FROM tr)""",
    body="SELECT s.id, CAST(l.idx AS DOUBLE) AS label, " + ", ".join(
        f"round(s.{c} / sd.{c}, 6) AS f_{i}" for i, c in enumerate(SENSOR_NUMERIC)) + ", " + ", ".join(
        f"CAST(CASE WHEN p.idx = {j} THEN 1 ELSE 0 END AS DOUBLE) AS f_{len(SENSOR_NUMERIC) + j}" for j in range(3)) +
    """ FROM sensor s CROSS JOIN sd JOIN lidx l ON l.value = s.Workout
LEFT JOIN pidx p ON p.value = s.Position"""))
def q_feature_vectors(spark, sf_dir):
    s = standins.sensor(spark, sf_dir)
    train, _ = sampling.train_test_split(s, "id")
    labels = features.label_index(s)
    model = features.logistic_pipeline(labelled=True).fit(labels.transform(train))
    out = model.transform(labels.transform(s))
    arr = vector_to_array(features.FEATURES)
    n = len(SENSOR_NUMERIC) + len(model.stages[0].labels)  # as many positions as the fitted index has
    return out.select("id", features.LABEL,
                      *[(F.round(arr[i], 6) if i < len(SENSOR_NUMERIC) else arr[i]).alias(f"f_{i}") for i in range(n)])


# ---------------------------------------------------------------- trained models
def _sensor_split(spark, sf_dir):
    """All rows, split; nothing is cut (``classify`` bounds the rows that a classifier is fitted on)."""
    return sampling.train_test_split(standins.sensor(spark, sf_dir), "id")


# What a fit gives differs by engine; the rows it is asked for, and what must hold for each, do not.
_LABEL_IDX = """lidx AS (SELECT value, CAST(row_number() OVER (ORDER BY n DESC, value) - 1 AS INTEGER) AS idx
  FROM (SELECT Workout AS value, count(*) AS n FROM sensor GROUP BY 1) t)"""
_PREDICTED = with_ctes(SENSOR, _LABEL_IDX, body=f"""SELECT s.id, CAST(l.idx AS DOUBLE) AS label, CAST(1 AS DOUBLE) AS prob_sum,
true AS is_argmax FROM sensor s JOIN lidx l ON l.value = s.Workout WHERE NOT {_TRAIN}""")


def _prediction_facts(preds):
    """Every test row with its label; probabilities add up to 1 and the prediction is the likeliest class."""
    p = F.col("probability")
    return preds.select(
        "id", features.LABEL, F.round(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), 6).alias("prob_sum"),
        (p[F.col("prediction").cast("int")] == F.array_max(p)).alias("is_argmax"))


@query("logreg_predictions", _PREDICTED)
def q_logreg_predictions(spark, sf_dir):
    train, test = _sensor_split(spark, sf_dir)
    return _prediction_facts(classify.train_and_predict(classify.logistic_grid(), train, test))


@query("rf_predictions", _PREDICTED)
def q_rf_predictions(spark, sf_dir):
    train, test = _sensor_split(spark, sf_dir)
    return _prediction_facts(classify.train_and_predict(classify.forest_grid(), train, test))


# Exercises that the readings decide: lines by quantity, so that a model which learns can be told from one that doesn't.
_RULED = """ruled AS (SELECT l_orderkey * 8 + l_linenumber AS id,
  CASE WHEN l_quantity < 20 THEN 'few' WHEN l_quantity < 35 THEN 'some' ELSE 'many' END AS Workout FROM lineitem),
held AS (SELECT Workout, count(*) AS n FROM ruled WHERE NOT """ + _TRAIN + """ GROUP BY 1),
facts AS (SELECT CAST(sum(n) AS BIGINT) AS n_rows, round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 6) AS prior_log_loss,
  round(max(n) / sum(n), 6) AS majority FROM held)"""


def _ruled(spark, sf_dir):
    number = lambda c: F.col(c).cast("double")
    quantity = F.col("l_quantity")
    return standins.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_linestatus").alias("Position"),
        F.when(quantity < 20, "few").when(quantity < 35, "some").otherwise("many").alias("Workout"),
        *[c.alias(n) for n, c in zip(SENSOR_NUMERIC, (number("l_quantity"), number("l_discount"), number("l_tax"), number("l_linenumber"),
                                                      number("l_discount") * 2, number("l_tax") * 3, number("l_quantity") * number("l_tax")), strict=True)])


@query("model_skill", with_ctes(_RULED, body="""SELECT model, n_rows, prior_log_loss, majority, true AS beats_prior, true AS beats_majority
FROM facts CROSS JOIN (VALUES ('logreg'), ('forest')) AS m(model)"""))
def q_model_skill(spark, sf_dir):
    """Both classifiers on separable exercises: a log loss below half the prior's, more accurate than the majority by half of what it misses."""
    rows = _ruled(spark, sf_dir)
    train, test = sampling.train_test_split(rows, "id")
    labels = features.label_index(rows)
    train, test = (labels.transform(x) for x in (sampling.sample_to_target(train, "id"), test))
    out = None
    for candidate in (classify.logistic_grid()[0], classify.forest_grid()[0]):
        preds = classify.fit(candidate, train).transform(test).withColumn("probability", vector_to_array("probability"))
        own = metrics.probability_skill(preds).withColumn("model", F.lit(candidate.name))
        out = own if out is None else out.unionByName(own)
    return out.select("model", "n_rows", F.round("prior_log_loss", 6).alias("prior_log_loss"), F.round("majority", 6).alias("majority"),
                      (F.col("log_loss") < 0.5 * F.col("prior_log_loss")).alias("beats_prior"),
                      (1 - F.col("accuracy") < 0.5 * (1 - F.col("majority"))).alias("beats_majority"))


_GRID = classify.logistic_grid() + classify.forest_grid()
_CANDIDATES = ", ".join(f"('{c.name}', {i}, '{c.describe()}')" for i, c in enumerate(_GRID))
_ID_FOLD = "(((((id % 2147483647) * 69069 + 1) % 2147483647) * 7919) % 2147483647) % 5"


@query("cv_scores", with_ctes(SENSOR, f"""held AS (SELECT CAST({_ID_FOLD} AS INTEGER) AS fold, count(*) AS n_rows
  FROM sensor WHERE {_TRAIN} GROUP BY 1), grid(model, candidate, params) AS (VALUES {_CANDIDATES})""",
    body="SELECT model, candidate, params, fold, n_rows, true AS in_range FROM grid CROSS JOIN held"))
def q_cv_scores(spark, sf_dir):
    """Each candidate on each fold: the rows it was scored on, and scores within [0, 1]; read back from the score table."""
    train, _ = _sensor_split(spark, sf_dir)
    path = fresh_folder(spark, "cv-scores")
    classify.cross_validate(_GRID, train, path=path)
    return scores.read_latest_scores(spark, path, ("model", "candidate", "fold")).select("model", "candidate", "params", "fold", "n_rows",
                         (F.col("f1").between(0, 1) & F.col("accuracy").between(0, 1)).alias("in_range"))


@query("cv_best", """WITH s AS (SELECT l_returnflag AS model, CAST(l_linenumber % 4 AS INTEGER) AS candidate,
  CAST(l_orderkey % 5 AS INTEGER) AS fold, avg(l_discount * 10) AS f1, avg(l_quantity / 50) AS accuracy FROM lineitem GROUP BY 1, 2, 3),
m AS (SELECT model, candidate, avg(f1) AS f, avg(accuracy) AS a FROM s GROUP BY 1, 2)
SELECT model, round(max(f), 6) AS best_mean_f1, round(max(a), 6) AS best_mean_accuracy FROM m GROUP BY 1""")
def q_cv_best(spark, sf_dir):
    """Best mean scores by model, over a rule-based score table of ``lineitem``."""
    li = standins.table(spark, sf_dir, "lineitem")
    table = li.groupBy(F.col("l_returnflag").alias("model"), (F.col("l_linenumber") % 4).cast("int").alias("candidate"),
                        (F.col("l_orderkey") % 5).cast("int").alias("fold")).agg(
        F.avg(F.col("l_discount") * 10).alias("f1"), F.avg(F.col("l_quantity") / 50).alias("accuracy"))
    best = classify.best_scores(table.withColumn("params", F.lit("rule")))
    return best.select("model", F.round("best_mean_f1", 6).alias("best_mean_f1"), F.round("best_mean_accuracy", 6).alias("best_mean_accuracy"))


def _sweep_sql(*models: str) -> str:
    ks = ", ".join(f"('{m}', {k})" for m in models for k in cluster.K_RANGE)
    return with_ctes(SENSOR, f"board(model, k) AS (VALUES {ks}), test AS (SELECT count(*) AS n_rows FROM sensor WHERE NOT {_TRAIN})",
                     body="SELECT model, k, n_rows, CAST(0 AS BIGINT) AS n_misplaced, true AS in_range, true AS beats_one FROM board CROSS JOIN test")


def _facts(board):
    """Each k of each model: all test rows placed, none misplaced, silhouette (if defined) within [-1, 1],
    and a fit to the train rows beyond a single cluster's: less squared distance by 5% at least, or likelier."""
    beats = F.when(F.col("model") == "kmeans", F.col("fit") < 0.95 * F.col("fit_of_one")).otherwise(F.col("fit") > F.col("fit_of_one") + 1e-6)
    return board.select("model", "k", "n_rows", "n_misplaced",
                        F.coalesce(F.col("silhouette").between(-1, 1), F.lit(True)).alias("in_range"), beats.alias("beats_one"))


@query("kmeans_sweep", _sweep_sql("kmeans"))
def q_kmeans_sweep(spark, sf_dir):
    return _facts(cluster.sweep("kmeans", *_sensor_split(spark, sf_dir)))


@query("gmm_sweep", _sweep_sql("gmm"))
def q_gmm_sweep(spark, sf_dir):
    return _facts(cluster.sweep("gmm", *_sensor_split(spark, sf_dir)))


@query("k_scoreboard", _sweep_sql("kmeans", "gmm"))
def q_k_scoreboard(spark, sf_dir):
    """Both clustering sweeps on one board, one row per (model, k): each writes its run, the latest of each are read."""
    path, halves = fresh_folder(spark, "k-scores"), _sensor_split(spark, sf_dir)
    for model in ("kmeans", "gmm"):
        cluster.sweep(model, *halves, path=path)
    return _facts(scores.read_latest_scores(spark, path)).orderBy("model", "k")


_MODEL_AUC = with_ctes(SENSOR, _LABEL_IDX, f"test AS (SELECT * FROM sensor WHERE NOT {_TRAIN})", body="""
SELECT l.idx AS class, count(*) FILTER (WHERE s.Workout = l.value) AS n_pos, count(*) FILTER (WHERE s.Workout <> l.value) AS n_neg,
true AS in_range FROM lidx l CROSS JOIN test s GROUP BY 1""")


def _model_scores(spark, sf_dir, grid):
    train, test = _sensor_split(spark, sf_dir)
    return metrics.ovr_scores(classify.train_and_predict(grid, train, test), "probability", features.LABEL)


def _model_auc(spark, sf_dir, grid):
    """Per class: the scored rows of either kind, and an area (if defined) within [0, 1]."""
    ovr = cut_lineage(_model_scores(spark, sf_dir, grid))
    counts = ovr.groupBy("class").agg(F.sum("positive").cast("long").alias("n_pos"), F.sum(1 - F.col("positive")).cast("long").alias("n_neg"))
    return counts.join(metrics.roc_auc(ovr), "class").select(
        "class", "n_pos", "n_neg", F.coalesce(F.col("auc").between(0, 1), F.lit(True)).alias("in_range"))


@query("rf_roc_auc", _MODEL_AUC)
def q_rf_roc_auc(spark, sf_dir):
    """Per-class one-vs-rest AUC of the cross-validated random forest on the test rows."""
    return _model_auc(spark, sf_dir, classify.forest_grid())


@query("logreg_roc_auc", _MODEL_AUC)
def q_logreg_roc_auc(spark, sf_dir):
    """Per-class one-vs-rest AUC of the cross-validated logistic regression on the test rows."""
    return _model_auc(spark, sf_dir, classify.logistic_grid())


@query("rf_roc_points", with_ctes(SENSOR, _LABEL_IDX, body="""SELECT idx AS class, CAST(0 AS DOUBLE) AS fpr_first,
CAST(1 AS DOUBLE) AS fpr_last, CAST(0 AS DOUBLE) AS tpr_first, CAST(1 AS DOUBLE) AS tpr_last, true AS rises FROM lidx"""))
def q_rf_roc_points(spark, sf_dir):
    """Per class, the ROC curve of the forest's test scores, written and read back: from (0, 0) to (1, 1), rising with
    the threshold's fall."""
    path = fresh_folder(spark, "curves")
    scores.write_curves(metrics.roc_points(cut_lineage(_model_scores(spark, sf_dir, classify.forest_grid()))), path)
    points = scores.read_curves(spark, path)
    rises = F.coalesce(F.corr("fpr", "tpr"), F.lit(0.0)) >= 0
    return points.groupBy("class").agg(
        F.min("fpr").alias("fpr_first"), F.max("fpr").alias("fpr_last"),
        F.min("tpr").alias("tpr_first"), F.max("tpr").alias("tpr_last"), rises.alias("rises"))
