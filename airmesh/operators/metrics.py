"""Classification and clustering metrics as distributed aggregates.

Nothing here windows or sorts raw rows: metrics come from per-(label,
prediction), per-(class, score) and per-cluster aggregates, whose size is
bounded by the number of classes, distinct scores and clusters.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, n``."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: ``accuracy``."""
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def weighted_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: ``f1`` = Σ_c (n_c / N) · 2·TP_c / (n_c + pred_c)  (label-frequency weighted)."""
    cm = confusion_matrix(df, label, prediction)
    by_label = cm.groupBy(F.col("label").alias("c")).agg(
        F.sum("n").alias("n_c"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))).alias("tp"))
    by_pred = cm.groupBy(F.col("prediction").alias("c")).agg(F.sum("n").alias("pred_c"))
    per = by_label.join(by_pred, "c", "left").select(
        "n_c", (F.lit(2.0) * F.coalesce("tp", F.lit(0)) / (F.col("n_c") + F.coalesce("pred_c", F.lit(0)))).alias("f"))
    return per.agg((F.sum(F.col("n_c") * F.col("f")) / F.sum("n_c")).alias("f1"))


def ovr_scores(df: DataFrame, scores: str = "scores", label: str = "label", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (row, class): ``*keep, class, score, positive`` (one-vs-rest).

    ``scores`` is an array<double> or an ML vector (e.g. ``probability``).
    """
    dtype = dict(df.dtypes)[scores]
    arr = F.col(scores) if dtype.startswith("array") else vector_to_array(scores)
    ex = df.select(*keep, F.col(label).alias("_label"), F.posexplode(arr).alias("class", "score"))
    return ex.select(*keep, "class", "score", (F.col("_label") == F.col("class")).cast("double").alias("positive"))


def _score_groups(ovr: DataFrame) -> DataFrame:
    """Per (class, distinct score): positives / negatives at that score and the
    cumulative counts over all scores ≥ it, plus class totals P and N.

    Exact two-level prefix sum, so no window ever holds a whole class, however
    its scores are spread (with model probabilities nearly every row is a
    distinct score and most lie near 0 or 1): distinct scores are range
    partitioned on (class, score), pinned in the checkpoint folder, summed
    inside their partition, and shifted by the totals of the class's
    partitions before — a table of one row per partition and class.
    """
    g = ovr.groupBy("class", "score").agg(
        F.sum("positive").alias("pos"), F.sum(F.lit(1.0) - F.col("positive")).alias("neg"))
    order = ["class", F.desc("score")]
    ranged = cut_lineage(g.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()))
    totals = ranged.groupBy("_pid", "class").agg(F.sum("pos").alias("bpos"), F.sum("neg").alias("bneg"))
    whole = Window.partitionBy("class")
    above = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", "class",
        F.coalesce(F.sum("bpos").over(above), F.lit(0.0)).alias("off_pos"),
        F.coalesce(F.sum("bneg").over(above), F.lit(0.0)).alias("off_neg"),
        F.sum("bpos").over(whole).alias("P"), F.sum("bneg").over(whole).alias("N"))
    local = Window.partitionBy("_pid", "class").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(offsets, ["_pid", "class"]).select(
        "class", "score", "pos", "neg",
        (F.col("off_pos") + F.sum("pos").over(local)).alias("cum_pos"),
        (F.col("off_neg") + F.sum("neg").over(local)).alias("cum_neg"),
        "P", "N",
    )


def roc_points(ovr: DataFrame) -> DataFrame:
    """``class, threshold, fpr, tpr`` per distinct score, plus the (0,0) start and
    (1,1) end points (threshold null), for every class in one job.  Where a
    class has no positive (negative) row, tpr (fpr) is undefined: null."""
    g = _score_groups(ovr)
    pts = g.select("class", F.col("score").alias("threshold"),
                   F.try_divide("cum_neg", "N").alias("fpr"), F.try_divide("cum_pos", "P").alias("tpr"))
    classes = ovr.select("class").distinct()
    ends = classes.select("class", F.lit(None).cast("double").alias("threshold"),
                          F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")).unionByName(
        classes.select("class", F.lit(None).cast("double").alias("threshold"),
                       F.lit(1.0).alias("fpr"), F.lit(1.0).alias("tpr")))
    return pts.unionByName(ends)


def roc_auc(ovr: DataFrame) -> DataFrame:
    """``class, auc``: trapezoid area under the ROC curve (tied scores share a diagonal).

    Σ over score groups of neg · (2·cum_pos − pos) / 2, divided by P·N; null for
    a class without positive or without negative rows.
    """
    g = _score_groups(ovr)
    return g.groupBy("class").agg(
        F.try_divide(F.sum(F.col("neg") * (F.lit(2.0) * F.col("cum_pos") - F.col("pos")) / F.lit(2.0)),
                     F.first("P") * F.first("N")).alias("auc"))


def _features(df: DataFrame, features) -> Column:
    if isinstance(features, (list, tuple)):
        return F.array(*[F.col(c).cast("double") for c in features])
    dtype = dict(df.dtypes)[features]
    return F.col(features) if dtype.startswith("array") else vector_to_array(features)


def silhouette(df: DataFrame, features, prediction: str = "prediction") -> DataFrame:
    """One row: mean silhouette with squared Euclidean distance.

    Closed form over per-cluster aggregates (n, Σx, Σ‖x‖²): the average squared
    distance of x to cluster C is ‖x‖² + Σ‖y‖²/n − 2·x·Σy/n.  The per-cluster
    table has one row per cluster (k rows, k set by the model) and reaches every
    point as a scalar subquery indexed by position, so no point-to-point pairs
    and no join are formed.  A point alone in its
    cluster scores 0; a single predicted cluster gives null (undefined).
    """
    x = df.select(_features(df, features).alias("x"), F.col(prediction).cast("double").alias("c"))
    dim = len(features) if isinstance(features, (list, tuple)) else _dimension(x)
    xs = [F.col("x")[d] for d in range(dim)]
    x = x.withColumn("sq", sum((v * v for v in xs[1:]), xs[0] * xs[0]))
    stats = x.groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sq").alias("sq_sum"),
        F.array(*[F.sum(v) for v in xs]).alias("vsum"))
    stats = cut_lineage(stats)  # k rows, computed once
    k = stats.count()  # number of clusters: bounded by the model, not the data
    table = stats.agg(F.collect_list(F.struct("c", "n", "sq_sum", "vsum")).alias("t")).scalar()

    def avg_dist(s):
        dot = sum((xs[d] * s["vsum"][d] for d in range(1, dim)), xs[0] * s["vsum"][0])
        return F.col("sq") + s["sq_sum"] / s["n"] - F.lit(2.0) * dot / s["n"]

    if k < 2:
        return x.agg(F.lit(None).cast("double").alias("silhouette"))
    x = x.withColumn("t", table)  # the k-row table, referenced once
    clusters = [F.col("t")[i] for i in range(k)]
    # one projection computes each cluster's distance once; later steps only combine columns
    d = x.select(
        "c",
        *[s["c"].alias(f"c{i}") for i, s in enumerate(clusters)],
        *[s["n"].alias(f"n{i}") for i, s in enumerate(clusters)],
        *[avg_dist(s).alias(f"d{i}") for i, s in enumerate(clusters)],
    )
    own = lambda name: F.coalesce(*[F.when(F.col(f"c{i}") == F.col("c"), F.col(f"{name}{i}")) for i in range(k)])
    ab = d.select(
        own("n").alias("own_n"),
        F.try_divide(own("d") * own("n"), own("n") - F.lit(1)).alias("a"),
        F.least(*[F.when(F.col(f"c{i}") != F.col("c"), F.col(f"d{i}")) for i in range(k)]).alias("b"),
    )
    a, b = F.col("a"), F.col("b")
    coef = (F.when(F.col("own_n") == 1, F.lit(0.0))
            .when(a < b, F.lit(1.0) - F.try_divide(a, b))
            .when(a > b, F.try_divide(b, a) - F.lit(1.0))
            .otherwise(F.lit(0.0)))
    return ab.select(coef.alias("s")).agg(F.avg("s").alias("silhouette"))


def _dimension(x: DataFrame) -> int:
    """Feature dimension (read from one row; all rows share it)."""
    row = x.select(F.size("x")).first()
    return int(row[0]) if row else 0


def probability_skill(preds: DataFrame, probability: str = "probability", label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: n_rows, log_loss and accuracy of scored rows, and those of always saying the label shares of these rows.

    ``probability`` is an array by class.  A model that learned nothing has no
    smaller log loss than the shares and is no more accurate than the most
    frequent label.  One aggregation by label; no row moves.
    """
    own = F.greatest(F.element_at(probability, F.col(label).cast("int") + 1), F.lit(1e-15))
    per = preds.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum(-F.ln(own)).alias("loss"),
                                   F.sum((F.col(label) == F.col(prediction)).cast("long")).alias("right"))
    total = F.sum("n")
    return per.agg(total.alias("n_rows"), (F.sum("loss") / total).alias("log_loss"),
                   (F.ln(total) - F.sum(F.col("n") * F.ln("n")) / total).alias("prior_log_loss"),
                   (F.sum("right") / total).alias("accuracy"), (F.max("n") / total).alias("majority"))
