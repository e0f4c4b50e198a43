"""Skew-safe lead equals a window lead, including groups spread over many partitions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from airmesh.operators.sequence import lead_in_group


def test_lead_in_group_matches_window_lead(spark):
    rnd = random.Random(3)
    rows = [(1, rnd.randint(1, 50), rnd.randint(0, 999)) for _ in range(2000)]  # one hot group
    rows += [(g, rnd.randint(1, 5), rnd.randint(0, 999)) for g in range(2, 60) for _ in range(rnd.randint(1, 6))]
    df = spark.createDataFrame(rows, "g long, k int, v long")
    want = df.withColumn("nxt", F.lead("v").over(Window.partitionBy("g").orderBy("k", "v")))
    got = lead_in_group(df, "g", ["k", "v"], "v", "nxt", partitions=7)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_lead_in_group_with_more_partitions_than_rows(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (2, 1, 30)], "g long, k int, v long")
    got = sorted(map(tuple, lead_in_group(df, "g", ["k"], "v", "nxt", partitions=16).collect()))
    assert got == [(1, 1, 10, 20), (1, 2, 20, None), (2, 1, 30, None)]


def test_global_rank_matches_row_number(spark):
    from airmesh.operators.sequence import global_rank

    rnd = random.Random(5)
    rows = [(f"v{rnd.randint(0, 300)}", rnd.randint(1, 20)) for _ in range(500)]
    df = spark.createDataFrame(rows, "value string, n long").dropDuplicates(["value"])
    order = [F.desc("n"), F.asc("value")]
    want = df.withColumn("pos", F.row_number().over(Window.orderBy(*order)).cast("long"))
    got = global_rank(df, order, "pos", partitions=6)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_default_partitioning_lets_aqe_merge_ranges(spark):
    from airmesh.operators.sequence import global_rank

    rnd = random.Random(11)
    rows = [(rnd.randint(1, 40), rnd.randint(1, 9), rnd.randint(0, 99)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g long, k int, v long")
    want = df.withColumn("nxt", F.lead("v").over(Window.partitionBy("g").orderBy("k", "v")))
    got = lead_in_group(df, "g", ["k", "v"], "v", "nxt")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    d = df.dropDuplicates(["g", "k", "v"])
    ranked = global_rank(d, ["g", "k", "v"], "pos")
    expect = d.withColumn("pos", F.row_number().over(Window.orderBy("g", "k", "v")).cast("long"))
    assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, expect.collect()))


def test_lead_with_null_values_groups_and_keys(spark):
    rnd = random.Random(9)
    pick = lambda *v: rnd.choice((None, *v))
    rows = [(pick(1, 2, 3), i, pick(5, 6)) for i in range(400)]
    df = spark.createDataFrame(rows, "g long, k int, v long")
    want = df.withColumn("nxt", F.lead("v").over(Window.partitionBy("g").orderBy("k")))
    got = lead_in_group(df, "g", ["k"], "v", "nxt", partitions=9)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
