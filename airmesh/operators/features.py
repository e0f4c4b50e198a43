"""Feature preparation: string indexing, one-hot, assembly, scaling (MLlib stages).

Stages are fitted on training rows only; the label never enters the feature
vector.  ``string_index`` is also available as a plain DataFrame aggregate
(frequency descending, ties alphabetical — the StringIndexer order).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import SENSOR_NUMERIC
from .sequence import global_rank

LABEL = "label"
FEATURES = "features"


def string_index(df: DataFrame, column: str) -> DataFrame:
    """``value, idx, n``: index by frequency desc, ties by value; nulls not indexed.

    Categories are ranked with a distributed global rank (``sequence.global_rank``),
    so even a very high-cardinality column is never ordered inside one task.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    ranked = global_rank(counts, [F.desc("n"), F.asc("value")], "pos")
    return ranked.select("value", (F.col("pos") - 1).cast("double").alias("idx"), "n")


def indexer(column: str, output: str, handle_invalid: str = "keep") -> StringIndexer:
    return StringIndexer(inputCol=column, outputCol=output, handleInvalid=handle_invalid,
                         stringOrderType="frequencyDesc")


def one_hot(index_col: str, output: str) -> OneHotEncoder:
    """handleInvalid=keep + dropLast: n categories (+1 kept) → vector of n."""
    return OneHotEncoder(inputCols=[index_col], outputCols=[output], handleInvalid="keep", dropLast=True)


def label_stage(label: str, labelled: bool) -> list:
    """The label indexer, unless the rows carry their label index already."""
    return [] if labelled else [indexer(label, LABEL, handle_invalid="error")]


def label_index(df: DataFrame, label: str = "Workout"):
    """Label indexer fitted on every row that will be trained on or scored.

    Labels are no features, so this leaks nothing; a label that a training fold
    lacks still has its index, and its rows count as errors of that fold.
    """
    return indexer(label, LABEL, handle_invalid="error").fit(df.select(label))


def logistic_pipeline(numeric: tuple[str, ...] = SENSOR_NUMERIC, position: str = "Position",
                      label: str = "Workout", labelled: bool = False) -> Pipeline:
    """Position index → one-hot; numeric assemble → std-scale (no centering);
    features = [scaled numeric, one-hot position]; label = indexed exercise."""
    return Pipeline(stages=[
        indexer(position, "position_idx"),
        one_hot("position_idx", "position_vec"),
        *label_stage(label, labelled),
        VectorAssembler(inputCols=list(numeric), outputCol="numeric_vec"),
        StandardScaler(inputCol="numeric_vec", outputCol="numeric_scaled", withStd=True, withMean=False),
        VectorAssembler(inputCols=["numeric_scaled", "position_vec"], outputCol=FEATURES),
    ])


def forest_pipeline(numeric: tuple[str, ...] = SENSOR_NUMERIC, position: str = "Position",
                    label: str = "Workout", labelled: bool = False) -> Pipeline:
    """Numeric readings + position index as features; label = indexed exercise."""
    return Pipeline(stages=[
        indexer(position, "position_idx"),
        *label_stage(label, labelled),
        VectorAssembler(inputCols=[*numeric, "position_idx"], outputCol=FEATURES),
    ])


def assemble(df: DataFrame, columns: tuple[str, ...], output: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)
