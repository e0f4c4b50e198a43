"""Itinerary and bounded-path queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.paths import path_text
from ..operators import graph, paths
from ..session import cut_lineage, discard_tables, materialize
from ..sources import standins
from .registry import query
from .sqltext import AIRPORT, ALL_AIRPORTS, ROUTE, haversine, with_ctes

# the two "countries" the itinerary and path workloads connect
COUNTRY_A = "Brand#11"
COUNTRY_B = "Brand#12"
MAX_STOPS = 2
MAX_HOPS = 3

_V = "v AS (SELECT DISTINCT id, country FROM airport)"
_E = "e AS (SELECT DISTINCT src_id AS src, dest_id AS dst FROM route)"


def _txt(*cols: str) -> str:
    return " || ' -> ' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)


def _oneway_sql(sc: str, dc: str, strict: bool) -> str:
    parts = []
    for stops in range(MAX_STOPS + 1):
        legs = [f"e r{i}" for i in range(stops + 1)]
        frm = legs[0]
        for i in range(1, stops + 1):
            frm += f" JOIN {legs[i]} ON r{i-1}.dst = r{i}.src"
        frm += f" JOIN v a ON a.id = r0.src JOIN v b ON b.id = r{stops}.dst"
        mids = [f"r{i}.dst" for i in range(stops)]
        conds = [f"a.country = '{sc}'", f"b.country = '{dc}'"]
        if strict:
            for i, m in enumerate(mids):
                frm += f" JOIN v m{i} ON m{i}.id = {m}"
            nodes = ["a.id", *mids, "b.id"]
            conds += [f"{x} <> {y}" for i, x in enumerate(nodes) for y in nodes[i + 1:]]
        else:
            conds += [f"{m} <> a.id AND {m} <> b.id" for m in mids]
        parts.append(f"SELECT a.id AS origin, b.id AS destination, {stops} AS stops, "
                     f"{_txt('a.id', *mids, 'b.id')} AS path FROM {frm} WHERE {' AND '.join(conds)}")
    return "\nUNION ALL\n".join(parts)


def _itin_sql(strict: bool, roundtrip: bool) -> str:
    body = _oneway_sql(COUNTRY_A, COUNTRY_B, strict)
    if roundtrip:
        body = f"SELECT DISTINCT * FROM ({body}\nUNION ALL\n{_oneway_sql(COUNTRY_B, COUNTRY_A, strict)}) u"
    return with_ctes(AIRPORT, ROUTE, _V, _E, body=body)


def _graph_inputs(spark, sf_dir):
    airports = standins.airports(spark, sf_dir)
    edges = cut_lineage(graph.route_edges(standins.routes(spark, sf_dir)))
    return airports.select("id", "country"), edges


@query("itineraries_motif", _itin_sql(strict=True, roundtrip=False))
def q_itineraries_motif(spark, sf_dir):
    v, e = _graph_inputs(spark, sf_dir)
    return paths.itineraries(v, e, COUNTRY_A, COUNTRY_B, MAX_STOPS, strict=True)


@query("itineraries_join", _itin_sql(strict=False, roundtrip=False))
def q_itineraries_join(spark, sf_dir):
    v, e = _graph_inputs(spark, sf_dir)
    return paths.itineraries(v, e, COUNTRY_A, COUNTRY_B, MAX_STOPS, strict=False)


@query("itineraries_roundtrip", _itin_sql(strict=True, roundtrip=True))
def q_itineraries_roundtrip(spark, sf_dir):
    v, e = _graph_inputs(spark, sf_dir)
    return paths.round_trip_itineraries(v, e, COUNTRY_A, COUNTRY_B, MAX_STOPS, strict=True)


ITINERARY_LIMIT = 1000


@query("itineraries_top", _itin_sql(strict=False, roundtrip=True).replace(
    "SELECT DISTINCT * FROM (", "SELECT * FROM (SELECT DISTINCT * FROM (", 1) +
    f") d ORDER BY stops, path LIMIT {ITINERARY_LIMIT}")
def q_itineraries_top(spark, sf_dir):
    """The reference's report: first 1000 round-trip itineraries (join form), in a total order."""
    v, e = _graph_inputs(spark, sf_dir)
    rt = paths.round_trip_itineraries(v, e, COUNTRY_A, COUNTRY_B, MAX_STOPS, strict=False)
    return rt.orderBy("stops", "path").limit(ITINERARY_LIMIT)


# ---------------------------------------------------------------- bounded paths
_WE = f"""we AS (
  SELECT p.src, p.dst, {haversine('s.latitude', 's.longitude', 'd.latitude', 'd.longitude')} AS km
  FROM (SELECT DISTINCT src_id AS src, dest_id AS dst FROM route) p
  JOIN airport s ON p.src = s.id JOIN airport d ON p.dst = d.id),
w AS (SELECT * FROM we WHERE NOT isnan(km) AND km > 0)"""


def _paths_sql(requested: bool = False) -> str:
    parts = []
    for hops in range(1, MAX_HOPS + 1):
        frm = "w e1" + "".join(f" JOIN w e{i} ON e{i-1}.dst = e{i}.src" for i in range(2, hops + 1))
        nodes = ["e1.src"] + [f"e{i}.dst" for i in range(1, hops + 1)]
        conds = [f"e1.src IN (SELECT id FROM airport WHERE country = '{COUNTRY_A}')",
                 f"e{hops}.dst IN (SELECT id FROM airport WHERE country = '{COUNTRY_B}')"]
        if requested:
            frm += f" JOIN req ON req.src = e1.src AND req.dst = e{hops}.dst"
            conds = []
        conds += [f"{x} <> {y}" for i, x in enumerate(nodes) for y in nodes[i + 1:]]
        km = " + ".join(f"e{i}.km" for i in range(1, hops + 1))
        parts.append(f"SELECT e1.src AS origin, e{hops}.dst AS target, {hops} AS hops, {_txt(*nodes)} AS path, "
                     f"{km} AS km, [{', '.join(nodes)}] AS ids FROM {frm} WHERE {' AND '.join(conds)}")
    return "\nUNION ALL\n".join(parts)


_P = f"bp AS (\n{_paths_sql()})"


def _search(spark, sf_dir):
    """All airports with weighted edges between them, and the sources and targets of path searches."""
    airports = standins.all_airports(spark, sf_dir)
    edges = cut_lineage(graph.weighted_edges(standins.routes(spark, sf_dir), airports, keep=(), distinct=True))
    ends = (airports.filter(F.col("country") == c).select("id") for c in (COUNTRY_A, COUNTRY_B))
    return edges, *ends


def _reported(best):
    return best.select("origin", "target", "hops", path_text("path").alias("path"), F.round("km", 4).alias("km"))


@query("bounded_paths", with_ctes(ALL_AIRPORTS, ROUTE, _WE, _P,
                                  body="SELECT origin, target, hops, path, round(km, 4) AS km FROM bp"))
def q_bounded_paths(spark, sf_dir):
    return _reported(paths.simple_paths(*_search(spark, sf_dir), MAX_HOPS))


def _extreme_sql(longest: bool) -> str:
    order = "km DESC" if longest else "km ASC"
    return with_ctes(ALL_AIRPORTS, ROUTE, _WE, _P, f"""best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY origin, target ORDER BY {order}, path) AS rn FROM bp) t
  WHERE rn = 1)""", body="SELECT origin, target, hops, path, round(km, 4) AS km FROM best")


_REQ = f"req AS (SELECT id AS src, id + 1 AS dst FROM airport WHERE country = '{COUNTRY_A}')"


@query("path_requests", with_ctes(ALL_AIRPORTS, ROUTE, _WE, _REQ, f"bp AS (\n{_paths_sql(requested=True)})",
                                  body="SELECT origin, target, hops, path, round(km, 4) AS km FROM bp"))
def q_path_requests(spark, sf_dir):
    """All simple paths of a request table: from each airport of one country to the next id."""
    edges, sources, _ = _search(spark, sf_dir)
    requests = sources.select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    return _reported(paths.request_paths(edges, requests, MAX_HOPS))


@query("shortest_path", _extreme_sql(longest=False))
def q_shortest_path(spark, sf_dir):
    return _reported(paths.shortest_paths(*_search(spark, sf_dir), MAX_HOPS))


@query("longest_path", _extreme_sql(longest=True))
def q_longest_path(spark, sf_dir):
    return _reported(paths.longest_paths(*_search(spark, sf_dir), MAX_HOPS))


# every route pair, over ghosts too: lengths between all parts' coordinates, ``UNKNOWN_KM`` where there is none
_PLACE = ALL_AIRPORTS.replace("airport AS", "place AS", 1)
_ALL_PAIRS = f"""pkm AS (
  SELECT p.src, p.dst, {haversine('s.latitude', 's.longitude', 'd.latitude', 'd.longitude')} AS km
  FROM (SELECT DISTINCT src_id AS src, dest_id AS dst FROM route WHERE src_id <> dest_id) p
  LEFT JOIN place s ON p.src = s.id LEFT JOIN place d ON p.dst = d.id),
w AS (SELECT src, dst, CASE WHEN NOT isnan(km) AND km > 0 THEN km ELSE CAST('{graph.UNKNOWN_KM!r}' AS DOUBLE) END AS km
      FROM pkm)"""


@query("path_labels", with_ctes(AIRPORT, _PLACE, ROUTE, _ALL_PAIRS, _P, """best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY origin, target ORDER BY km, path) AS rn FROM bp) t
  WHERE rn = 1),
ex AS (SELECT origin, target, unnest(ids) AS vid, generate_subscripts(ids, 1) AS pos FROM best)""",
    body="""SELECT ex.origin, ex.target,
       string_agg(CAST(ex.vid AS VARCHAR) || ':' || coalesce(a.name, '???'), ' -> ' ORDER BY ex.pos) AS labels
FROM ex LEFT JOIN airport a ON a.id = ex.vid GROUP BY ex.origin, ex.target"""))
def q_path_labels(spark, sf_dir):
    """Shortest paths over all route pairs; ghosts on the way are labelled ``???``."""
    airports = standins.airports(spark, sf_dir)
    routes = standins.routes(spark, sf_dir)
    pairs = materialize(graph.route_edges(routes), "route-pairs")
    discard_tables(routes)
    edges = materialize(graph.weighted_edges(pairs, standins.all_airports(spark, sf_dir), "src", "dst",
                                             keep=(), unknown_km=graph.UNKNOWN_KM), "edges")
    discard_tables(pairs)
    ends = (airports.filter(F.col("country") == c).select("id") for c in (COUNTRY_A, COUNTRY_B))
    best = paths.shortest_paths(edges, *ends, MAX_HOPS)
    if set(edges.inputFiles()).isdisjoint(best.inputFiles()):  # only its first hops read them, and are written
        discard_tables(edges)
    return paths.label_paths(best.select("origin", "target", "path"), airports).select("origin", "target", "labels")
