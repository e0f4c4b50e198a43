"""Score sinks count committed runs only; delimited files quarantine what they can't take."""

import time

import pytest
from pyspark.sql import types as T

from airmesh.operators import cluster
from airmesh.sources import delimited, scores
from airmesh.sources.schemas import Field

BOARD = "model string, k int, silhouette double"


def _read(spark, path):
    return [(r.k, r.silhouette) for r in scores.read_latest_scores(spark, path).collect()]


def test_a_half_written_run_is_never_the_latest(spark, tmp_dir):
    path = f"{tmp_dir}/scores"
    scores.write_scores(spark.createDataFrame([("m", 2, 0.1), ("m", 3, 0.2)], BOARD), path, "a")
    time.sleep(1.1)
    broken = spark.createDataFrame([("m", 2, 0.9)], BOARD)
    scores.write_rows(broken, path, "b")  # and then the driver is lost
    assert _read(spark, path) == [(2, 0.1), (3, 0.2)]
    scores.commit_run(spark, path, "b")
    assert _read(spark, path) == [(2, 0.9), (3, 0.2)]
    # rows that come in after the entry make the run unreadable, not larger
    scores.write_rows(broken, path, "b")
    assert _read(spark, path) == [(2, 0.1), (3, 0.2)]


def test_a_sweep_writes_its_board(spark, tmp_dir):
    rows = spark.createDataFrame([(float(i % 3), float(i % 3 * 7 + i / 100)) for i in range(30)], "a double, b double")
    board = cluster.sweep("kmeans", rows, rows, ("a", "b"), (2, 3), path=f"{tmp_dir}/board").orderBy("k").collect()
    read = scores.read_latest_scores(spark, f"{tmp_dir}/board").select(*cluster.SWEEP_SCHEMA.names).collect()
    assert read == board and len(read) == 2


def test_curves_are_read_once_finished(spark, tmp_dir):
    points = spark.createDataFrame([(0, 0.0, 0.0), (0, 1.0, 1.0), (1, 0.5, 1.0)], "class int, fpr double, tpr double")
    scores.write_curves(points, f"{tmp_dir}/roc")
    assert sorted(map(tuple, scores.read_curves(spark, f"{tmp_dir}/roc").select("class", "fpr", "tpr").collect())) == sorted(map(tuple, points.collect()))
    points.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("class").parquet(f"{tmp_dir}/broken")
    with pytest.raises(FileNotFoundError):
        scores.read_curves(spark, f"{tmp_dir}/broken")


def test_every_line_is_taken_or_rejected_with_its_reason(spark, tmp_dir):
    path = f"{tmp_dir}/x.dat"
    with open(path, "w") as f:
        f.write('1,"a, b",2.5\n2,c,notnum\n\\N,d,1\n3,,4\n4,e\n5,f,6,7\n"6","g ""q""", 8 \n')
    fields = (Field(0, "id", T.LongType()), Field(1, "name", T.StringType()), Field(2, "x", T.DoubleType()))
    good, bad = delimited.read_quarantined(spark, path, fields, 3)
    assert sorted(map(tuple, good.collect())) == [(1, "a, b", 2.5), (6, 'g "q"', 8.0)]
    assert sorted((r.reason, r.id) for r in bad.collect()) == [
        ("malformed x", "2"), ("missing id", "\\N"), ("missing name", "3"), ("number of fields", "4"), ("number of fields", "5")]


def test_delimited_round_trip(spark, tmp_dir):
    rows = [("1", 'say "hi", you', None), ("2", "plain", "x")]
    df = spark.createDataFrame(rows, "id string, name string, more string")
    delimited.write_delimited(df, f"{tmp_dir}/out")
    fields = (Field(0, "id", T.StringType()), Field(1, "name", T.StringType()), Field(2, "more", T.StringType()))
    raw = spark.read.options(**delimited.CSV_OPTIONS).schema(delimited.text_schema(3)).csv(f"{tmp_dir}/out")
    assert sorted(map(tuple, raw.collect())) == sorted(rows)
    assert [r.reason for r in delimited.read_quarantined(spark, f"{tmp_dir}/out", fields, 3)[1].collect()] == ["missing more"]
