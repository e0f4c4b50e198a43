"""Shared SQL fragments for the DuckDB oracle: stand-in views and expressions.

Each oracle query is one self-contained SELECT over the raw parquet views
(``part``, ``supplier``, ``lineitem``, ``embeddings`` …), so the stand-in
tables are spelled out as CTEs here, mirroring ``sources.standins``.
"""

from __future__ import annotations

ALL_AIRPORTS = """airport AS (
  SELECT p_partkey AS id, p_name AS name, p_brand AS country,
         CAST((p_partkey*37) % 1600 AS DOUBLE)/10.0 - 80.0 AS latitude,
         CAST((p_partkey*101) % 3600 AS DOUBLE)/10.0 - 180.0 AS longitude
  FROM part)"""
AIRPORT = ALL_AIRPORTS.removesuffix(")") + " WHERE p_partkey % 10 <> 3)"

ALL_AIRLINES = """airline AS (SELECT s_suppkey AS id, s_name AS name FROM supplier)"""
AIRLINE = ALL_AIRLINES.removesuffix(")") + " WHERE s_suppkey % 7 <> 0)"

ROUTE = """route AS (
  SELECT airline_id, src_id, dest_id FROM (
    SELECT l_suppkey AS airline_id, l_partkey AS src_id,
           lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS dest_id
    FROM lineitem) t
  WHERE dest_id IS NOT NULL)"""

ORDER_ROUTE = """route AS (
  SELECT airline_id, src_id, dest_id FROM (
    SELECT o_custkey AS airline_id, o_orderkey AS src_id,
           lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS dest_id
    FROM orders) t
  WHERE dest_id IS NOT NULL)"""

AIRPORT_TEXT = r"""airport_text AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_type AS city, p_brand AS country,
         CASE WHEN p_size < 10 THEN '\N' ELSE upper(substr(p_name, 1, 3)) END AS iata,
         CASE WHEN p_size > 45 THEN NULL ELSE 'K' || CAST(p_partkey AS VARCHAR) END AS icao,
         CASE WHEN p_retailprice >= 1900 THEN 'n/a' ELSE CAST(p_size*100 AS VARCHAR) END AS altitude,
         CAST((p_size % 25) - 12 AS VARCHAR) AS timezone_offset
  FROM part)"""

SENSOR = """sensor AS (
  SELECT vec_id AS id, CAST(vec_id % 10 AS INTEGER) AS Subject,
         CASE vec_id % 3 WHEN 0 THEN 'wrist' WHEN 1 THEN 'pocket' ELSE 'leg' END AS Position,
         CAST(vec_id % 5 AS INTEGER) AS Session,
         CAST(embedding[1] AS DOUBLE) AS A_x, CAST(embedding[2] AS DOUBLE) AS A_y,
         CAST(embedding[3] AS DOUBLE) AS A_z, CAST(embedding[4] AS DOUBLE) AS G_x,
         CAST(embedding[5] AS DOUBLE) AS G_y, CAST(embedding[6] AS DOUBLE) AS G_z,
         CAST(embedding[7] AS DOUBLE) AS C_1, 'w' || CAST(label AS VARCHAR) AS Workout
  FROM embeddings)"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"pow(sin(radians({lat2} - {lat1})/2), 2) + cos(radians({lat1}))*cos(radians({lat2}))"
         f"*pow(sin(radians({lon2} - {lon1})/2), 2)")
    return f"(6371.0088 * (2.0 * asin(least(1.0, sqrt({a})))))"


WEIGHTED_EDGE = f"""wedge AS (
  SELECT r.src_id AS src, r.dest_id AS dst, r.airline_id,
         {haversine('s.latitude', 's.longitude', 'd.latitude', 'd.longitude')} AS km
  FROM route r JOIN airport s ON r.src_id = s.id JOIN airport d ON r.dest_id = d.id)"""

VALID_WEIGHTED_EDGE = "vwedge AS (SELECT * FROM wedge WHERE NOT isnan(km) AND km > 0)"


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
