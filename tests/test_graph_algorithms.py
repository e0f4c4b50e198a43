"""Graph algorithms on tiny goldens and random graphs against brute force."""

from collections import defaultdict, deque

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airmesh.operators import communities, components, pagerank, paths, skew
from airmesh.operators.graph import Graph


def _graph(spark, edges, vertices=None):
    e = spark.createDataFrame(edges, "src long, dst long")
    ids = vertices if vertices is not None else sorted({x for p in edges for x in p})
    v = spark.createDataFrame([(i, f"n{i}", "X") for i in ids], "id long, name string, country string")
    return Graph(v, e)


def test_pagerank_golden(spark):
    g = _graph(spark, [(1, 2), (1, 2), (1, 3), (2, 3), (3, 4), (5, 4)])
    got = {r.id: r.rank for r in pagerank.pagerank(g, tol=1e-5).collect()}
    want = {1: 0.487595, 2: 0.763898, 3: 1.275060, 4: 1.985852, 5: 0.487595}
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-6)
    assert sum(got.values()) == pytest.approx(5.0)


def test_components_golden(spark):
    g = _graph(spark, [(1, 2), (1, 2), (1, 3), (2, 3), (3, 4), (5, 4)])
    got = {r.id: r.component for r in components.connected_components(g).collect()}
    assert set(got.values()) == {1}


def test_label_propagation_two_cycle(spark):
    g = _graph(spark, [(10, 20)])
    for steps, want in ((1, {10: 20, 20: 10}), (2, {10: 10, 20: 20}), (3, {10: 20, 20: 10})):
        got = {r.id: r.label for r in communities.label_propagation(g, steps).collect()}
        assert got == want


def _brute_components(n_ids, edges):
    adj = defaultdict(set)
    for a, b in edges:
        adj[a].add(b)
        adj[b].add(a)
    comp = {}
    for s in sorted(n_ids):
        if s in comp:
            continue
        q, seen = deque([s]), {s}
        while q:
            u = q.popleft()
            for w in adj[u]:
                if w not in seen:
                    seen.add(w)
                    q.append(w)
        m = min(seen)
        for u in seen:
            comp[u] = m
    return comp


edge_lists = st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=edge_lists)
def test_components_match_bfs(spark, edges):
    ids = sorted({x for p in edges for x in p} | {30, 31})  # two isolated declared vertices
    g = _graph(spark, edges, ids)
    got = {r.id: r.component for r in components.connected_components(g).collect()}
    assert got == _brute_components(ids, edges)


def _brute_pagerank(ids, edges, tol=1e-5, reset=0.15):
    out = defaultdict(int)
    for a, _ in edges:
        out[a] += 1
    r = {i: 1.0 for i in ids}
    while True:
        s = defaultdict(float)
        for a, b in edges:
            s[b] += r[a] / out[a]
        new = {i: reset + (1 - reset) * s[i] for i in ids}
        delta = max(abs(new[i] - r[i]) for i in ids)
        r = new
        if delta < tol:
            break
    tot = sum(r.values())
    return {i: v * len(ids) / tot for i, v in r.items()}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=edge_lists)
def test_pagerank_matches_power_iteration(spark, edges):
    ids = sorted({x for p in edges for x in p})
    got = {r.id: r.rank for r in pagerank.pagerank(_graph(spark, edges), tol=1e-5).collect()}
    want = _brute_pagerank(ids, edges)
    for i in ids:
        assert got[i] == pytest.approx(want[i], abs=1e-9)


def _brute_lpa(ids, edges, steps):
    lab = {i: i for i in ids}
    for _ in range(steps):
        votes = defaultdict(lambda: defaultdict(int))
        for a, b in edges:
            votes[b][lab[a]] += 1
            votes[a][lab[b]] += 1
        lab = {i: (min(votes[i].items(), key=lambda kv: (-kv[1], kv[0]))[0] if votes[i] else lab[i]) for i in ids}
    return lab


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=edge_lists, steps=st.integers(1, 6))
def test_label_propagation_matches_brute_force(spark, edges, steps):
    ids = sorted({x for p in edges for x in p})
    got = {r.id: r.label for r in communities.label_propagation(_graph(spark, edges), steps).collect()}
    assert got == _brute_lpa(ids, edges, steps)


def _brute_simple_paths(edges, sources, targets, max_hops):
    adj = defaultdict(list)
    for a, b, w in edges:
        adj[a].append((b, w))
    out = set()

    def walk(path, km):
        if len(path) - 1 >= max_hops:
            return
        for b, w in adj[path[-1]]:
            if b in path:
                continue
            p2 = path + [b]
            if b in targets:
                out.add((path[0], b, tuple(p2), round(km + w, 6)))
            walk(p2, km + w)

    for s in sources:
        walk([s], 0.0)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=35))
def test_simple_paths_match_dfs(spark, pairs):
    pairs = sorted(set(pairs))
    edges = [(a, b, float(1 + (a * 7 + b) % 5)) for a, b in pairs]
    sources, targets = {0, 1, 2, 3}, {3, 4, 5, 6}
    e = spark.createDataFrame(edges, "src long, dst long, km double")
    src = spark.createDataFrame([(i,) for i in sorted(sources)], "id long")
    dst = spark.createDataFrame([(i,) for i in sorted(targets)], "id long")
    got = {(r.origin, r.target, tuple(r.path), round(r.km, 6))
           for r in paths.simple_paths(e, src, dst, 3).collect()}
    assert got == _brute_simple_paths(edges, sources, targets, 3)


def test_extreme_paths_pick_min_and_max(spark):
    e = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (1, 3, 5.0), (1, 4, 1.0), (4, 3, 2.0)],
                              "src long, dst long, km double")
    one = spark.createDataFrame([(1,)], "id long")
    three = spark.createDataFrame([(3,)], "id long")
    p = paths.simple_paths(e, one, three, 3)
    short = paths.extreme_paths(p).first()
    long_ = paths.extreme_paths(p, longest=True).first()
    assert list(short.path) == [1, 2, 3] and short.km == 2.0
    assert list(long_.path) == [1, 3] and long_.km == 5.0


def test_src_equals_dst_has_no_path(spark):
    e = spark.createDataFrame([(1, 2, 1.0), (2, 1, 1.0)], "src long, dst long, km double")
    one = spark.createDataFrame([(1,)], "id long")
    assert paths.simple_paths(e, one, one, 3).count() == 0


def test_skew_split_join_matches_plain_join(spark, monkeypatch):

    monkeypatch.setattr(skew, "MIN_HOT_DEGREE", 3)
    edges = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 5), (3, 6)], "src long, dst long")
    vals = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "id long, v double")
    deg = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    hot = skew.find_hot_keys(deg, edges.count())
    assert hot.count == 1
    got = sorted(tuple(r) for r in skew.join_vertex_values(edges, "src", vals, hot).collect())
    want = sorted(tuple(r) for r in edges.join(vals.withColumnRenamed("id", "src"), "src").collect())
    assert got == want


def test_restrict_to_requests_and_unknown_labels(spark):
    e = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (1, 4, 2.0)], "src long, dst long, km double")
    src = spark.createDataFrame([(1,)], "id long")
    dst = spark.createDataFrame([(3,), (4,)], "id long")
    p = paths.simple_paths(e, src, dst, 3)
    req = spark.createDataFrame([(1, 3)], "src long, dst long")
    kept = paths.restrict_to_requests(p, req).collect()
    assert [list(r.path) for r in kept] == [[1, 2, 3]]
    names = spark.createDataFrame([(1, "a"), (3, "c")], "id long, name string")
    lab = paths.label_paths(paths.restrict_to_requests(p, req), names).first()
    assert lab.labels == "1:a -> 2:??? -> 3:c"


def test_pagerank_fixed_rounds_matches_power_iteration(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 2), (4, 2), (5, 1)]
    ids = sorted({x for p in edges for x in p})
    for rounds in (1, 3, 12, 25):
        got = {r.id: r.rank for r in pagerank.pagerank(_graph(spark, edges), tol=None, max_iter=rounds).collect()}
        out = defaultdict(int)
        for a, _ in edges:
            out[a] += 1
        r = {i: 1.0 for i in ids}
        for _ in range(rounds):
            s = defaultdict(float)
            for a, b in edges:
                s[b] += r[a] / out[a]
            r = {i: 0.15 + 0.85 * s[i] for i in ids}
        tot = sum(r.values())
        for i in ids:
            assert got[i] == pytest.approx(r[i] * len(ids) / tot, abs=1e-12)


def test_large_state_path_bucketed_tables(spark, monkeypatch):
    """Force the path used when vertex state exceeds the broadcast threshold."""
    monkeypatch.setattr(pagerank, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr(communities, "fits_broadcast", lambda *a, **k: False)
    g = _graph(spark, [(1, 2), (1, 2), (1, 3), (2, 3), (3, 4), (5, 4)])
    got = {r.id: r.rank for r in pagerank.pagerank(g, tol=1e-5).collect()}
    assert got[4] == pytest.approx(1.985852, abs=1e-6) and got[1] == pytest.approx(0.487595, abs=1e-6)
    edges = [(1, 2), (2, 3), (3, 1), (4, 5), (10, 20)]
    ids = sorted({x for p in edges for x in p})
    for steps in (1, 2, 5):
        lab = {r.id: r.label for r in communities.label_propagation(_graph(spark, edges), steps).collect()}
        assert lab == _brute_lpa(ids, edges, steps)


@pytest.mark.parametrize("state", ["broadcast", "bucketed"])
def test_label_rounds_vote_on_fewer_edges(spark, monkeypatch, state):
    """Cliques settle at once, a chain later, a pair never: votes fall, labels are those of whole rounds."""
    cliques = [(10 * c + i, 10 * c + j) for c in range(12) for i in range(5) for j in range(i)]
    edges = [*cliques, *((500 + i, 501 + i) for i in range(6)), (4, 14), (900, 901)]
    ids = sorted({x for p in edges for x in p})
    if state == "bucketed":  # the whole state is over the threshold, its changed part is not
        monkeypatch.setattr(communities, "fits_broadcast", lambda spark, n, *a: n < len(ids))
    for steps in (3, 6, 9):
        rows = []
        got = {r.id: r.label for r in communities.label_propagation(_graph(spark, edges), steps, rows).collect()}
        assert got == _brute_lpa(ids, edges, steps)
    assert rows[0] == 2 * len(edges) and all(a >= b for a, b in zip(rows, rows[1:])) and rows[-1] < rows[0] / 4


def test_broadcast_threshold_check(spark):

    assert skew._size_in_bytes("10MB") == 10 << 20 and skew._size_in_bytes("10485760b") == 10 << 20
    assert skew._size_in_bytes("1g") == 1 << 30 and skew._size_in_bytes("2048") == 2048
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not skew.fits_broadcast(spark, 10)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
        assert skew.fits_broadcast(spark, 1000) and not skew.fits_broadcast(spark, 10_000_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hub_is_spread_evenly(spark, monkeypatch):
    """Half of all edges start at one vertex: its edges lie apart, in even parts, and results stay the same."""
    monkeypatch.setattr(skew, "MIN_HOT_DEGREE", 50)
    rows = [(0, 1 + i % 400) for i in range(2000)] + [(1 + i % 400, (i * 7) % 401) for i in range(2000)]
    edges = spark.createDataFrame(rows, "src long, dst long")
    laid = skew.bucket_senders(edges, "src", 8, "hub_test")
    assert {r.id for r in laid.hot.ids.collect()} == {0}
    per_part = [r["count"] for r in laid.hot_edges.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_part) > 1 and max(per_part) <= 1.5 * min(per_part)
    values = edges.select(F.col("src").alias("id")).distinct().withColumn("v", F.col("id") * 10)
    got = sorted((r.src, r.dst, r.v) for r in laid.with_values(values).collect())
    assert got == sorted((a, b, a * 10) for a, b in rows)
    g = Graph(spark.createDataFrame([], "id long"), edges)
    small = {r.id: round(r["rank"], 9) for r in pagerank.pagerank(g).collect()}
    monkeypatch.setattr(pagerank, "fits_broadcast", lambda *a, **k: False)
    assert {r.id: round(r["rank"], 9) for r in pagerank.pagerank(g).collect()} == small


def test_unconverged_ranks_are_an_error(spark, monkeypatch):


    monkeypatch.setattr(pagerank, "MAX_ITER", 2)
    g = Graph(spark.createDataFrame([], "id long"), spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 2)], "src long, dst long"))
    with pytest.raises(RuntimeError):
        pagerank.pagerank(g, tol=1e-12)
    assert pagerank.pagerank(g, tol=1e-12, max_iter=2).count() == 3
