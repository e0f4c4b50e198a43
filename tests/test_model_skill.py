"""Probability scoring against the label shares tells a model that learned from one that didn't."""

import math

import pytest
from pyspark.sql import functions as F

from airmesh.operators import metrics


def _scored(spark, rows):
    df = spark.createDataFrame(rows, "label double, probability array<double>")
    return df.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))


def test_skill_by_hand(spark):
    rows = [(0.0, [0.8, 0.1, 0.1]), (0.0, [0.3, 0.6, 0.1]), (1.0, [0.2, 0.7, 0.1]), (2.0, [0.0, 1.0, 0.0])]
    got = metrics.probability_skill(_scored(spark, rows)).first()
    assert got.n_rows == 4 and got.accuracy == 0.5 and got.majority == 0.5
    assert got.log_loss == pytest.approx(-(math.log(0.8) + math.log(0.3) + math.log(0.7) + math.log(1e-15)) / 4)
    assert got.prior_log_loss == pytest.approx(-(0.5 * math.log(0.5) + 0.5 * math.log(0.25)))


def test_a_model_that_learned_nothing_has_no_skill(spark):
    labels = [0.0] * 60 + [1.0] * 30 + [2.0] * 10
    got = metrics.probability_skill(_scored(spark, [(y, [0.6, 0.3, 0.1]) for y in labels])).first()
    assert got.log_loss == pytest.approx(got.prior_log_loss) and got.accuracy == got.majority == 0.6
    guess = metrics.probability_skill(_scored(spark, [(y, [0.2, 0.3, 0.5]) for y in labels])).first()
    assert guess.log_loss > guess.prior_log_loss and guess.accuracy < guess.majority


def test_no_rows(spark):
    got = metrics.probability_skill(_scored(spark, [(0.0, [1.0])]).filter("label > 0")).first()
    assert got.n_rows is None and got.log_loss is None
