"""Branch and bound for shortest / longest paths: same answers as enumeration, fewer rows on the way."""

import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from airmesh.operators import paths
from airmesh.session import fresh_folder

from .conftest import SF_SMALL


def _plain(edges, sources, targets, max_hops, longest):
    """{(origin, target): (hops, path, km)} by walking every simple path."""
    best = {}

    def walk(path, km):
        if len(path) > 1 and path[-1] in targets:
            key = (-km if longest else km, " -> ".join(map(str, path)))
            pair = (path[0], path[-1])
            if pair not in best or key < best[pair][0]:
                best[pair] = (key, len(path) - 1, tuple(path), km)
        if len(path) <= max_hops:
            for a, b, w in edges:
                if a == path[-1] and b not in path:
                    walk([*path, b], km + w)

    for s in sources:
        walk([s], 0.0)
    return {pair: v[1:] for pair, v in best.items()}


def _random_graph(seed, n=11, m=45):
    rnd = random.Random(seed)
    pairs = {(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)}
    # few distinct whole weights, so that kilometres tie and the text decides
    edges = [(a, b, float(rnd.randrange(1, 4))) for a, b in sorted(pairs)]
    return edges, rnd.sample(range(n), 4), rnd.sample(range(n), rnd.choice([1, 2, 5]))


@pytest.mark.parametrize("seed", range(5))
def test_searches_equal_enumeration(spark, seed):
    edges, sources, targets = _random_graph(seed)
    e = spark.createDataFrame(edges, "src long, dst long, km double")
    a, b = (spark.createDataFrame([(i,) for i in x], "id long") for x in (sources, targets))
    hops = 2 + seed % 3
    for search, longest in ((paths.shortest_paths, False), (paths.longest_paths, True)):
        got = {(r.origin, r.target): (r.hops, tuple(r.path), r.km) for r in search(e, a, b, hops).collect()}
        assert got == _plain(edges, sources, targets, hops, longest)


def _frontier_rows(monkeypatch, run):
    rows, write = [], paths.materialize

    def counted(df, name="state"):
        out = write(df, name)
        if name == "frontier":
            rows.append(out.count())
        return out

    monkeypatch.setattr(paths, "materialize", counted)
    run().collect()
    monkeypatch.setattr(paths, "materialize", write)
    return rows


def test_bounds_drop_rows_before_they_are_written(spark, monkeypatch):
    # one origin, one target: a good direct route, and many stops that can only be worse
    stops = range(10, 60)
    edges = [(0, 1, 100.0)] + [(0, s, 90.0) for s in stops] + [(s, s + 1, 20.0) for s in stops] + [(s, 1, 30.0) for s in stops]
    e = spark.createDataFrame(edges, "src long, dst long, km double")
    a, b = spark.createDataFrame([(0,)], "id long"), spark.createDataFrame([(1,)], "id long")
    every = _frontier_rows(monkeypatch, lambda: paths.simple_paths(e, a, b, 4))
    short = _frontier_rows(monkeypatch, lambda: paths.shortest_paths(e, a, b, 4))
    assert short[0] == 0 < every[0] == len(stops) and sum(short) < sum(every)
    # the same with routes that can only be shorter: none can be the longest
    low = e.withColumn("km", F.when((F.col("src") == 0) & (F.col("dst") == 1), 100.0).otherwise(1.0))
    long_ = _frontier_rows(monkeypatch, lambda: paths.longest_paths(low, a, b, 4))
    assert long_[0] == 0 and sum(long_) < sum(every)
    assert paths.longest_paths(low, a, b, 4).first().km == paths.shortest_paths(e, a, b, 4).first().km == 100.0


def test_a_worse_way_to_a_vertex_is_not_followed(spark, monkeypatch):
    # every vertex is a direct neighbour of the origin: longer ways to it are dominated
    n = 12
    edges = [(0, i, 1.0) for i in range(1, n)] + [(i, j, 1.0) for i in range(1, n) for j in range(1, n) if i != j] + [(i, 99, 5.0) for i in range(1, n)]
    e = spark.createDataFrame(edges, "src long, dst long, km double")
    a, b = spark.createDataFrame([(0,)], "id long"), spark.createDataFrame([(99,), (98,)], "id long")  # 98 can't be reached
    every = _frontier_rows(monkeypatch, lambda: paths.simple_paths(e, a, b, 4))
    short = _frontier_rows(monkeypatch, lambda: paths.shortest_paths(e, a, b, 4))
    assert every == [n - 1, (n - 1) * (n - 2)] and short == [n - 1, 0]


def test_last_hop_merges_only_where_it_pays(spark):
    """With more edges into targets than vertices the best row of each vertex is taken first; same answers."""
    edges = [(i, j, float(1 + (i * j) % 5)) for i in range(8) for j in range(8) if i != j]
    e = spark.createDataFrame(edges, "src long, dst long, km double")
    ids = spark.createDataFrame([(i,) for i in range(8)], "id long")
    got = {(r.origin, r.target): (r.hops, tuple(r.path), r.km) for r in paths.shortest_paths(e, ids, ids, 3).collect()}
    assert got == _plain(edges, range(8), set(range(8)), 3, False)


def test_edges_toward_bound_what_is_left(spark):
    e = spark.createDataFrame([(1, 2, 1.0), (2, 3, 2.0), (3, 4, 4.0), (2, 4, 9.0), (5, 1, 1.0), (7, 8, 1.0)], "src long, dst long, w double")
    four = spark.createDataFrame([(4,)], "id long")
    near = paths.edges_toward(e, four, 3)
    assert {(r.src, r.dst) for r in near.last.collect()} == {(3, 4), (2, 4)}
    assert {(r.src, r.dst, r.rest) for r in near.more[1].collect()} == {(1, 2, 9.0), (2, 3, 4.0)}
    assert {(r.src, r.dst, r.rest) for r in near.more[2].collect()} == {(1, 2, 6.0), (2, 3, 4.0), (5, 1, 10.0)}
    far = paths.edges_toward(e, four, 3, longest=True)
    assert {(r.src, r.dst, r.rest) for r in far.more[2].collect()} == {(1, 2, 9.0), (2, 3, 4.0), (5, 1, 10.0)}


def test_labels_name_ghosts(spark):
    rows = entry.queries()["path_labels"](spark, SF_SMALL).collect()
    assert any(":???" in r.labels for r in rows) and all(r.labels.count(":") >= 2 for r in rows)


def test_labels_follow_the_shortest_way_of_three_hops(spark, tmp_dir):
    """A near way of three hops over a ghost beats a far one of two; a stop without any row is passed too."""
    parts = [(1, "a", "Brand#11"), (2, "b", "Brand#12"), (3, "ghost", "x"), (5, "e", "x"), (22, "far", "x"), (4, "d", "Brand#12")]
    legs = [(1, 3), (3, 5), (5, 2), (1, 22), (22, 2), (1, 999), (999, 4), (1, 1)]
    lines = [(o, n, k, 1) for o, leg in enumerate(legs) for n, k in enumerate(leg)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_dir}/part.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(f"{tmp_dir}/lineitem.parquet")
    rows = entry.queries()["path_labels"](spark, tmp_dir).collect()
    want = {(1, 2, "1:a -> 3:??? -> 5:e -> 2:b"), (1, 4, "1:a -> 999:??? -> 4:d")}
    assert {tuple(r) for r in rows} == want
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_dir}/{t}.parquet/*.parquet')")
    assert set(con.sql(entry.oracle_sql()["path_labels"]).fetchall()) == want


def _tables(spark):
    return {p.name for p in Path(fresh_folder(spark, "x").removeprefix("file:")).parent.glob("*")}


def test_paths_are_labelled_a_part_at_a_time(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(k % 5, rnd.randrange(9), [rnd.randrange(9) for _ in range(rnd.randrange(1, 5))], "x y") for k in range(40)]
    rows += rows[:7] + [(1, None, [3], None), (2, 2, [], "no stop"), (2, 2, None, "no path")]  # equal paths stay one row each
    table = spark.createDataFrame(rows, "origin long, target long, path array<bigint>, `a b` string")
    names = spark.createDataFrame([(i, None if i == 4 else f"n{i}") for i in range(7)] + [(2, "a")], "id long, name string")
    known = {i: f"n{i}" for i in range(7) if i != 4} | {2: "a"}
    want = sorted(str((*r, " -> ".join(f"{i}:{known.get(i, '???')}" for i in r[2]))) for r in rows if r[2])
    for most in (1000, 10, 1):
        monkeypatch.setattr(paths, "LABEL_ROWS", most)
        before = _tables(spark)
        out = paths.label_paths(table, names)
        assert out.columns == [*table.columns, "labels"]
        assert sorted(str(tuple(r)) for r in out.collect()) == want
        assert {t.rsplit("-", 1)[0] for t in _tables(spark) - before} == ({"paths"} if most == 1000 else {"labels"})


def test_labels_send_other_columns_once(spark, monkeypatch):
    """Not with each stop: what a path's rows take on their way doesn't grow with its stops times its columns."""
    table = spark.createDataFrame([(i, [i, i + 1, i + 2, i + 3], "x" * 50) for i in range(20)], "origin long, path array<bigint>, note string")
    names = spark.createDataFrame([(i, "n") for i in range(30)], "id long, name string")
    plan = paths.label_paths(table, names)._jdf.queryExecution().optimizedPlan().toString()
    keys = [line for line in plan.splitlines() if "Aggregate [" in line and "collect_list" in line]
    assert len(keys) == 1 and keys[0].strip().split("Aggregate [")[1].startswith("_row#") and "path" not in keys[0].split("]")[0]


def test_path_labels_keep_no_table_of_their_way(spark):
    before = _tables(spark)
    out = entry.queries()["path_labels"](spark, SF_SMALL)
    assert out.count()
    left = {t.rsplit("-", 1)[0] for t in _tables(spark) - before}
    assert not left & {"lead", "route-pairs", "edges"}
