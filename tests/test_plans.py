"""Plan-shape checks: pruning / pushdown reach the scan, partial aggregation, shared exchanges."""

import __spark_entry__ as entry
from airmesh.operators import classify, paths
from airmesh.plans import routing
from airmesh.sources import standins

from .conftest import SF_SMALL


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_route_lines_prune_columns_and_keep_rows(spark):
    plan = _plan(standins.route_lines(spark, SF_SMALL))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scan) == 1
    assert "l_extendedprice" not in scan[0] and "l_shipdate" not in scan[0] and "l_tax" not in scan[0]
    assert "l_quantity" not in scan[0] and "DataFilters: []" in scan[0]  # every line is a route's


def test_flagship_plan_shape(spark):
    plan = _plan(entry.queries()["airline_extremes"](spark, SF_SMALL))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    part = [s for s in scans if "p_partkey" in s]
    assert part and all("p_name" not in s and "p_type" not in s for s in part)  # coordinates need the key only
    assert "partial_sum" in plan  # map-side combine before the carrier shuffle
    assert "TakeOrderedAndProject" in plan and "ReusedExchange" in plan


def test_no_cartesian_products_in_path_searches(spark):
    for name in ("itineraries_roundtrip", "bounded_paths", "shortest_path", "connected_components"):
        plan = _plan(entry.queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_round_trip_plan_is_short(spark):
    plan = entry.queries()["itineraries_roundtrip"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 40


def test_strict_itineraries_are_subset_of_loose(spark):
    v = standins.airports(spark, SF_SMALL).select("id", "country")
    from airmesh.operators.graph import route_edges
    e = route_edges(standins.routes(spark, SF_SMALL))
    strict = paths.round_trip_itineraries(v, e, routing.COUNTRY_A, routing.COUNTRY_B, 2, strict=True)
    loose = paths.round_trip_itineraries(v, e, routing.COUNTRY_A, routing.COUNTRY_B, 2, strict=False)
    assert strict.subtract(loose).count() == 0


def test_parameter_grids():
    lr = classify.logistic_grid()
    assert sorted((c.params["regParam"], c.params["elasticNetParam"]) for c in lr) == [
        (0.0, 0.0), (0.0, 1.0), (0.1, 0.0), (0.1, 1.0)]
    assert [c.params["numTrees"] for c in classify.forest_grid()] == [40, 70, 100, 130]
