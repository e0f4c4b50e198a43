"""Stand-in tables and itinerary counts equal the published fixture figures (sf0.001)."""

from pyspark.sql import functions as F

from airmesh.operators import graph, paths
from airmesh.plans import routing
from airmesh.sources import standins

from .conftest import SF_SMALL


def test_standin_sizes(spark):
    lines = standins.table(spark, SF_SMALL, "lineitem")
    orders = standins.table(spark, SF_SMALL, "orders")
    airports = standins.airports(spark, SF_SMALL)
    routes = standins.routes(spark, SF_SMALL)
    assert standins.all_airports(spark, SF_SMALL).count() == 200 and airports.count() == 180
    # every line but the last of its order starts a route, every order but the last of its customer too
    assert routes.count() == lines.count() - lines.select("l_orderkey").distinct().count() == 4527
    assert standins.order_routes(spark, SF_SMALL).count() == orders.count() - orders.select("o_custkey").distinct().count()
    assert graph.weighted_edges(routes, airports).count() > 0


def test_itinerary_counts_by_stops(spark):
    v = standins.airports(spark, SF_SMALL).select("id", "country")
    e = graph.route_edges(standins.routes(spark, SF_SMALL))
    loose = paths.itineraries(v, e, routing.COUNTRY_A, routing.COUNTRY_B, 2, strict=False)
    strict = paths.itineraries(v, e, routing.COUNTRY_A, routing.COUNTRY_B, 2, strict=True)
    by = lambda df: {r.stops: r["count"] for r in df.groupBy("stops").count().collect()}
    lo, st = by(loose), by(strict)
    assert sum(lo.values()) == 4672 and sum(st.values()) == 3689
    assert all(st.get(k, 0) <= n for k, n in lo.items())


def test_shortest_paths_equal_the_best_of_all_paths(spark):
    airports = standins.airports(spark, SF_SMALL)
    edges = graph.weighted_edges(standins.routes(spark, SF_SMALL), airports, keep=(), distinct=True)
    a = airports.filter(F.col("country") == routing.COUNTRY_A).select("id")
    b = airports.filter(F.col("country") == routing.COUNTRY_B).select("id")
    want = paths.extreme_paths(paths.simple_paths(edges, a, b, 3))
    got = paths.shortest_paths(edges, a, b, 3)
    rows = lambda df: sorted((r.origin, r.target, r.hops, tuple(r.path), round(r.km, 6)) for r in df.collect())
    assert rows(got) == rows(want)


def test_labels_of_equal_paths_stay_apart(spark):
    paths_ = spark.createDataFrame([(1, 2, [1, 2]), (1, 2, [1, 2])], "origin long, target long, path array<long>")
    names = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    assert [r.labels for r in paths.label_paths(paths_, names).collect()] == ["1:a -> 2:b"] * 2
