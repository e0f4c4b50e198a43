"""Classifiers with grid search and k-fold cross-validation.

Folds come from a key hash (``sampling.fold_of``), so the same rows land in
the same fold whatever the partition layout.  Each (parameter set, fold) fit
is scored for weighted F1 *and* accuracy from one confusion-matrix aggregate,
so a single pass replaces running the whole search once per metric.  Fits run
concurrently from a small thread pool (independent Spark jobs), like
``CrossValidator(parallelism=...)``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scores import write_scores
from . import features as feat
from .metrics import confusion_matrix
from .sampling import NUM_FOLDS, SAMPLE_TARGET, fold_of, sample_to_target

# --- fixed values: seed and parameter grids of the workload ---
SEED = 12321
REG_PARAMS = (0.0, 0.1)
ELASTIC_NET_PARAMS = (0.0, 1.0)
NUM_TREES = (40, 70, 100, 130)
# --- end fixed values ---
PARALLELISM = 4


@dataclass(frozen=True)
class Candidate:
    name: str
    params: dict

    def describe(self) -> str:
        return ",".join(f"{k}={v}" for k, v in sorted(self.params.items()))


def logistic_grid() -> list[Candidate]:
    """regParam {0, 0.1} × elasticNetParam {0, 1}; multinomial, no standardization, 100 iterations."""
    return [Candidate("logreg", {"regParam": r, "elasticNetParam": e}) for r in REG_PARAMS for e in ELASTIC_NET_PARAMS]


def forest_grid() -> list[Candidate]:
    """numTrees {40, 70, 100, 130}, seeded."""
    return [Candidate("forest", {"numTrees": n}) for n in NUM_TREES]


def _estimator(c: Candidate):
    if c.name == "logreg":
        return LogisticRegression(featuresCol=feat.FEATURES, labelCol=feat.LABEL, maxIter=100,
                                  family="multinomial", standardization=False, **c.params)
    return RandomForestClassifier(featuresCol=feat.FEATURES, labelCol=feat.LABEL, seed=SEED, **c.params)


def _pipeline(c: Candidate) -> Pipeline:
    prep = feat.logistic_pipeline(labelled=True) if c.name == "logreg" else feat.forest_pipeline(labelled=True)
    return Pipeline(stages=[*prep.getStages(), _estimator(c)])


def fit(c: Candidate, train: DataFrame) -> PipelineModel:
    """Preprocessing and model fitted together on ``train`` (rows with their label index) only."""
    return _pipeline(c).fit(train)


def _f1_accuracy(cm_rows) -> tuple[float, float]:
    n_c, tp, pred_c = {}, {}, {}
    for r in cm_rows:
        n_c[r.label] = n_c.get(r.label, 0) + r.n
        pred_c[r.prediction] = pred_c.get(r.prediction, 0) + r.n
        if r.label == r.prediction:
            tp[r.label] = tp.get(r.label, 0) + r.n
    total = sum(n_c.values())
    f1 = sum(n * 2.0 * tp.get(c, 0) / (n + pred_c.get(c, 0)) for c, n in n_c.items()) / total
    return f1, sum(tp.values()) / total


SCORE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("candidate", T.IntegerType()),
    T.StructField("params", T.StringType()), T.StructField("fold", T.IntegerType()),
    T.StructField("f1", T.DoubleType()), T.StructField("accuracy", T.DoubleType()),
    T.StructField("n_rows", T.LongType()),
])


def cross_validate(grid: list[Candidate], train: DataFrame, key: str = "id", folds: int = NUM_FOLDS,
                   parallelism: int = PARALLELISM, path: str | None = None, target: int = SAMPLE_TARGET) -> DataFrame:
    """Per (candidate, fold): weighted F1, accuracy and row count of the held-out fold.

    Every row of the held-out fold is scored; at most ``target`` of the others
    are fitted on.  The score table has ``len(grid) × folds`` rows (bounded by
    the search size); with ``path``, it is also appended to the score table there.
    """
    labels = feat.label_index(train) if feat.LABEL not in train.columns else None
    # kept for all fits of the search; what a lost executor held is read again
    data = (labels.transform(train) if labels else train).withColumn("_fold", fold_of(key, folds)).persist()

    def run(job):
        i, c, f = job
        model = fit(c, fitted[f])
        preds = model.transform(data.filter(F.col("_fold") == f))
        cells = confusion_matrix(preds, feat.LABEL, "prediction").collect()  # classes squared
        f1, acc = _f1_accuracy(cells)
        return (c.name, i, c.describe(), f, f1, acc, sum(r.n for r in cells))

    jobs = [(i, c, f) for i, c in enumerate(grid) for f in range(folds)]
    try:
        fitted = [sample_to_target(data.filter(F.col("_fold") != f), key, target) for f in range(folds)]
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            rows = list(pool.map(run, jobs))
    finally:
        data.unpersist()
    scores = train.sparkSession.createDataFrame(rows, SCORE_SCHEMA)
    if path:
        write_scores(scores, path)
    return scores


def summarize(scores: DataFrame) -> DataFrame:
    """Mean over folds per candidate: ``model, candidate, params, mean_f1, mean_accuracy``."""
    return scores.groupBy("model", "candidate", "params").agg(
        F.avg("f1").alias("mean_f1"), F.avg("accuracy").alias("mean_accuracy"))


def best_scores(scores: DataFrame) -> DataFrame:
    """Per model: best mean F1 and best mean accuracy over the grid."""
    return summarize(scores).groupBy("model").agg(
        F.max("mean_f1").alias("best_mean_f1"), F.max("mean_accuracy").alias("best_mean_accuracy"))


def best_candidate(grid: list[Candidate], scores: DataFrame, metric: str = "mean_f1") -> Candidate:
    row = summarize(scores).orderBy(F.desc(metric), "candidate").first()
    return grid[row["candidate"]]


def train_and_predict(grid: list[Candidate], train: DataFrame, test: DataFrame, key: str = "id",
                      target: int = SAMPLE_TARGET) -> DataFrame:
    """Cross-validate, refit the best candidate by F1 on the training rows (at most ``target``), score the test rows.

    Returns ``id, label, prediction, probability`` (probability as array<double>).
    """
    from pyspark.ml.functions import vector_to_array

    labels = feat.label_index(train.select("Workout").unionByName(test.select("Workout")))
    train, test = labels.transform(train), labels.transform(test)
    scores = cross_validate(grid, train, key, target=target)
    best = best_candidate(grid, scores)
    preds = fit(best, sample_to_target(train, key, target)).transform(test)
    return preds.select(key, feat.LABEL, "prediction", vector_to_array("probability").alias("probability"))
