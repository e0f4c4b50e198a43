"""Score and curve sinks / sources (parquet tables, append with a run id).

A score table is a folder of ``rows``, tagged with their run, and ``runs``, a
manifest with one entry for each run, written after all of its rows.  Rows
count only once their run's entry is there and names as many as there are: a
run that broke off half-way, or is still writing, is never read as the latest,
and may be written again under another id.  The reader returns, per key, the
rows of the latest run that has the key, so repeated runs never mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_MANIFEST = "run_id string, written_at timestamp, n_rows long"


def write_rows(scores: DataFrame, path: str, run_id: str) -> None:
    """Append the rows of a run; they are read once ``commit_run`` has entered it."""
    scores.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(f"{path}/rows")


def commit_run(spark: SparkSession, path: str, run_id: str) -> None:
    """Enter a run, with the number of its rows, in the manifest."""
    entry = (spark.read.parquet(f"{path}/rows").filter(F.col("run_id") == run_id).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("written_at"), "n_rows"))
    entry.coalesce(1).write.mode("append").parquet(f"{path}/runs")


def write_scores(scores: DataFrame, path: str, run_id: str | None = None) -> str:
    """Append ``scores`` to the score table at ``path`` as one run; returns the run id."""
    run_id = run_id or uuid.uuid4().hex
    write_rows(scores, path, run_id)
    commit_run(scores.sparkSession, path, run_id)
    return run_id


def committed_scores(spark: SparkSession, path: str) -> DataFrame:
    """All rows of runs whose manifest entry names as many rows as there are, with ``run_id`` and ``written_at``."""
    rows = spark.read.parquet(f"{path}/rows")
    runs = spark.read.schema(_MANIFEST).parquet(f"{path}/runs").groupBy("run_id").agg(
        F.max("written_at").alias("written_at"), F.max("n_rows").alias("n_rows"))
    whole = rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).join(runs, "run_id").filter("n = n_rows").select("run_id", "written_at")
    return rows.join(whole, "run_id")


def read_latest_scores(spark: SparkSession, path: str, keys: tuple[str, ...] = ("model", "k")) -> DataFrame:
    """Rows of the most recent committed run per key, ordered by key."""
    w = Window.partitionBy(*keys).orderBy(F.desc("written_at"), F.desc("run_id"))
    return (committed_scores(spark, path).withColumn("_r", F.dense_rank().over(w)).filter(F.col("_r") == 1)
            .drop("_r").orderBy(*keys))


def write_curves(points: DataFrame, path: str) -> None:
    """ROC points partitioned by class (one folder per class)."""
    points.write.mode("overwrite").partitionBy("class").parquet(path)


def read_curves(spark: SparkSession, path: str) -> DataFrame:
    """The points that ``write_curves`` left; a write that broke off has no ``_SUCCESS`` mark, and isn't read."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        raise FileNotFoundError(f"{path} holds no finished curves")
    return spark.read.parquet(path)
