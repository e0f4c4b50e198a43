"""Flight-network queries: scans, cleaning, weighted edges, carrier totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import carriers, graph
from ..session import fresh_folder
from ..sources import delimited, standins
from ..sources.schemas import AIRPORT_FIELDS, pick
from .registry import query
from .sqltext import (
    AIRLINE,
    AIRPORT,
    ALL_AIRLINES,
    ALL_AIRPORTS,
    AIRPORT_TEXT,
    ROUTE,
    VALID_WEIGHTED_EDGE,
    WEIGHTED_EDGE,
    haversine,
    with_ctes,
)


def _ctx(spark, sf_dir):
    """All airports, the carriers with a name, all routes."""
    return standins.all_airports(spark, sf_dir), standins.airlines(spark, sf_dir), standins.routes(spark, sf_dir)


# ---------------------------------------------------------------- flagship
@query("airline_extremes", with_ctes(
    ALL_AIRPORTS, AIRLINE, ROUTE, WEIGHTED_EDGE, VALID_WEIGHTED_EDGE,
    """tot AS (SELECT airline_id, sum(km) AS total_km, count(*) AS n_routes FROM vwedge GROUP BY airline_id),
ext AS (
  (SELECT 'max' AS kind, * FROM tot ORDER BY total_km DESC, airline_id LIMIT 1)
  UNION ALL
  (SELECT 'min' AS kind, * FROM tot ORDER BY total_km ASC, airline_id LIMIT 1))""",
    body="""SELECT e.kind, e.airline_id, coalesce(a.name, 'Airline#' || CAST(e.airline_id AS VARCHAR)) AS name,
       round(e.total_km, 2) AS total_km, e.n_routes
FROM ext e LEFT JOIN airline a ON a.id = e.airline_id"""))
def q_airline_extremes(spark, sf_dir):
    airports, airlines, routes = _ctx(spark, sf_dir)
    return carriers.airline_extremes(routes, airports, airlines)


@query("airline_totals", with_ctes(
    ALL_AIRPORTS, ROUTE, WEIGHTED_EDGE, VALID_WEIGHTED_EDGE,
    body="SELECT airline_id, round(sum(km), 4) AS total_km, count(*) AS n_routes FROM vwedge GROUP BY airline_id"))
def q_airline_totals(spark, sf_dir):
    airports, _, routes = _ctx(spark, sf_dir)
    return carriers.airline_totals(routes, airports)


# ---------------------------------------------------------------- edges
@query("weighted_edges", with_ctes(
    ALL_AIRPORTS, ROUTE, WEIGHTED_EDGE, VALID_WEIGHTED_EDGE,
    body="SELECT src, dst, airline_id, round(km, 4) AS km FROM vwedge"))
def q_weighted_edges(spark, sf_dir):
    airports, _, routes = _ctx(spark, sf_dir)
    return graph.weighted_edges(routes, airports).withColumn("km", F.round("km", 4))


@query("weighted_edges_distinct", with_ctes(
    AIRPORT, ROUTE,
    f"""pairs AS (SELECT DISTINCT src_id, dest_id FROM route),
e AS (SELECT p.src_id AS src, p.dest_id AS dst,
             {haversine('s.latitude', 's.longitude', 'd.latitude', 'd.longitude')} AS km
      FROM pairs p JOIN airport s ON p.src_id = s.id JOIN airport d ON p.dest_id = d.id)""",
    body="SELECT src, dst, round(km, 4) AS km FROM e WHERE NOT isnan(km) AND km > 0"))
def q_weighted_edges_distinct(spark, sf_dir):
    # ghosts have no coordinates: edges that touch them go
    airports, routes = standins.airports(spark, sf_dir), standins.routes(spark, sf_dir)
    return graph.weighted_edges(routes, airports, keep=(), distinct=True).withColumn("km", F.round("km", 4))


@query("route_edges", with_ctes(ROUTE, body="SELECT DISTINCT src_id AS src, dest_id AS dst FROM route"))
def q_route_edges(spark, sf_dir):
    return graph.route_edges(standins.routes(spark, sf_dir))


@query("adjacency", with_ctes(
    ALL_AIRPORTS, ROUTE, WEIGHTED_EDGE, VALID_WEIGHTED_EDGE,
    body="""SELECT src, count(*) AS out_degree, count(DISTINCT dst) AS n_targets, round(sum(km), 4) AS total_km
FROM vwedge GROUP BY src"""))
def q_adjacency(spark, sf_dir):
    airports, _, routes = _ctx(spark, sf_dir)
    return graph.out_degrees(graph.weighted_edges(routes, airports))


@query("graph_summary", with_ctes(
    AIRPORT, ROUTE,
    """ids AS (SELECT id FROM airport UNION SELECT src_id FROM route UNION SELECT dest_id FROM route)""",
    body="""SELECT (SELECT count(*) FROM airport) AS n_declared, (SELECT count(*) FROM ids) AS n_vertices,
       (SELECT count(*) FROM ids) - (SELECT count(*) FROM airport) AS n_ghosts,
       (SELECT count(*) FROM route) AS n_edges,
       (SELECT CAST(coalesce(sum(CASE WHEN src_id = dest_id THEN 1 ELSE 0 END), 0) AS BIGINT) FROM route) AS n_self_loops"""))
def q_graph_summary(spark, sf_dir):
    airports, routes = standins.airports(spark, sf_dir), standins.routes(spark, sf_dir)
    return graph.graph_summary(graph.build_graph(airports, routes))


# ---------------------------------------------------------------- scans / cleaning
@query("scan_airports", with_ctes(ALL_AIRPORTS, body="SELECT id, name, latitude, longitude FROM airport"))
def q_scan_airports(spark, sf_dir):
    fields = pick(AIRPORT_FIELDS, "id", "name", "latitude", "longitude")
    return delimited.clean_named(standins.all_airports(spark, sf_dir), fields)


@query("scan_airlines", with_ctes(ALL_AIRLINES, body="SELECT id, name FROM airline"))
def q_scan_airlines(spark, sf_dir):
    from ..sources.schemas import AIRLINE_FIELDS
    return delimited.clean_named(standins.all_airlines(spark, sf_dir), pick(AIRLINE_FIELDS, "id", "name"))


@query("scan_routes", with_ctes(ROUTE, body="SELECT airline_id, src_id, dest_id FROM route"))
def q_scan_routes(spark, sf_dir):
    from ..sources.schemas import ROUTE_FIELDS
    return delimited.clean_named(standins.routes(spark, sf_dir), pick(ROUTE_FIELDS, "airline_id", "src_id", "dest_id"))


@query("reject_missing", with_ctes(
    AIRPORT_TEXT,
    body=r"""SELECT TRY_CAST(id AS BIGINT) AS id, name, iata, icao FROM airport_text
WHERE id IS NOT NULL AND name IS NOT NULL AND iata IS NOT NULL AND icao IS NOT NULL
  AND id <> '\N' AND name <> '\N' AND iata <> '\N' AND icao <> '\N'"""))
def q_reject_missing(spark, sf_dir):
    fields = pick(AIRPORT_FIELDS, "id", "name", "iata", "icao")
    return delimited.clean_named(standins.airport_text(spark, sf_dir), fields)


@query("typed_cast", with_ctes(
    AIRPORT_TEXT,
    body=r"""SELECT TRY_CAST(id AS BIGINT) AS id, name, TRY_CAST(altitude AS DOUBLE) AS altitude,
       TRY_CAST(timezone_offset AS INTEGER) AS timezone_offset FROM airport_text
WHERE id IS NOT NULL AND name IS NOT NULL AND altitude IS NOT NULL AND timezone_offset IS NOT NULL
  AND id <> '\N' AND name <> '\N' AND altitude <> '\N' AND timezone_offset <> '\N'"""))
def q_typed_cast(spark, sf_dir):
    fields = pick(AIRPORT_FIELDS, "id", "name", "altitude", "timezone_offset")
    return delimited.clean_named(standins.airport_text(spark, sf_dir), fields)


# ---------------------------------------------------------------- delimited files, written and read back
_CSV_FIELDS = ("id", "name", "iata", "icao", "altitude", "timezone_offset")
_CSV_REASON = r"""CASE WHEN iata = '\N' THEN 'missing iata' WHEN icao IS NULL THEN 'missing icao'
  WHEN TRY_CAST(altitude AS DOUBLE) IS NULL THEN 'malformed altitude' END"""


def _airport_file(spark, sf_dir):
    """The airports as a header-less file with all fields of its layout, and its accepted and rejected rows."""
    path, text = fresh_folder(spark, "airports-csv"), standins.airport_text(spark, sf_dir)
    known = set(text.columns)
    delimited.write_delimited(text.select(*[F.col(f.name) if f.name in known else F.lit("0").alias(f.name) for f in AIRPORT_FIELDS]), path)
    return delimited.read_quarantined(spark, path, pick(AIRPORT_FIELDS, *_CSV_FIELDS), len(AIRPORT_FIELDS))


@query("csv_airports", with_ctes(AIRPORT_TEXT, body=f"""SELECT CAST(id AS BIGINT) AS id, name, iata, icao,
       TRY_CAST(altitude AS DOUBLE) AS altitude, CAST(timezone_offset AS INTEGER) AS timezone_offset FROM airport_text WHERE {_CSV_REASON} IS NULL"""))
def q_csv_airports(spark, sf_dir):
    return _airport_file(spark, sf_dir)[0]


@query("csv_airport_rejects", with_ctes(AIRPORT_TEXT, body=f"SELECT id, name, {_CSV_REASON} AS reason FROM airport_text WHERE {_CSV_REASON} IS NOT NULL"))
def q_csv_airport_rejects(spark, sf_dir):
    return _airport_file(spark, sf_dir)[1].select("id", "name", "reason")


@query("airports_by_country", with_ctes(
    ALL_AIRPORTS, body="SELECT id, country FROM airport WHERE country = 'Brand#11'"))
def q_airports_by_country(spark, sf_dir):
    a = standins.all_airports(spark, sf_dir)
    return a.filter(F.col("country") == "Brand#11").select("id", "country")
