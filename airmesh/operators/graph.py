"""Property graphs as two DataFrames and the distance-weighted edge table.

A graph is ``vertices(id, attrs...)`` plus ``edges(src, dst, attrs...)``, a
directed multigraph.  Vertex ids that occur only in edges are "ghosts": the
algorithms see them, attribute reports drop them at the inner join.

Joins against the vertex table are plain equi-joins; Spark decides at run
time (AQE) whether the vertex side is small enough to broadcast — its size is
measured, never assumed — and otherwise sort-merges with skew splitting.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_KM, haversine_km, valid_distance

#: Half the way round the earth: no two airports lie further apart.
UNKNOWN_KM = math.pi * EARTH_RADIUS_KM


@dataclass(frozen=True)
class Graph:
    vertices: DataFrame  # id + attributes, one row per id
    edges: DataFrame  # src, dst (+ attributes)


def unique_vertices(vertices: DataFrame, key: str = "id") -> DataFrame:
    """One row per id; duplicates resolve to the smallest attribute tuple (deterministic)."""
    attrs = [c for c in vertices.columns if c != key]
    if not attrs:
        return vertices.select(key).distinct()
    return (
        vertices.groupBy(key)
        .agg(F.min(F.struct(*attrs)).alias("_a"))
        .select(key, *[F.col(f"_a.{c}").alias(c) for c in attrs])
    )


def route_edges(routes: DataFrame, src: str = "src_id", dst: str = "dest_id", distinct: bool = True) -> DataFrame:
    """Rename route endpoints to ``src``/``dst`` (optionally one row per pair)."""
    e = routes.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    return e.distinct() if distinct else e


def build_graph(vertices: DataFrame, routes: DataFrame, src: str = "src_id", dst: str = "dest_id",
                distinct_edges: bool = False) -> Graph:
    edge_attrs = [c for c in routes.columns if c not in (src, dst)]
    edges = routes.select(F.col(src).alias("src"), F.col(dst).alias("dst"), *edge_attrs)
    if distinct_edges:
        edges = edges.distinct()
    return Graph(unique_vertices(vertices), edges)


def all_vertex_ids(graph: Graph) -> DataFrame:
    """Declared ids ∪ edge endpoints (ghosts included) as ``id``."""
    ends = graph.edges.select(F.col("src").alias("id")).union(graph.edges.select(F.col("dst").alias("id")))
    return graph.vertices.select("id").union(ends).distinct()


def graph_summary(graph: Graph) -> DataFrame:
    """One row: declared vertices, algorithm vertices, ghosts, edges, self-loops.

    Each figure is one aggregate; the vertex and edge counts enter the declared
    count's row as scalar subqueries (no join).
    """
    n_vertices = all_vertex_ids(graph).agg(F.count(F.lit(1))).scalar()
    n_edges = graph.edges.agg(F.count(F.lit(1))).scalar()
    n_loops = graph.edges.agg(
        F.coalesce(F.sum((F.col("src") == F.col("dst")).cast("long")), F.lit(0))).scalar()
    return graph.vertices.agg(F.count(F.lit(1)).alias("n_declared")).select(
        "n_declared", n_vertices.alias("n_vertices"), (n_vertices - F.col("n_declared")).alias("n_ghosts"),
        n_edges.alias("n_edges"), n_loops.alias("n_self_loops"),
    )


def weighted_edges(routes: DataFrame, airports: DataFrame, src: str = "src_id", dst: str = "dest_id",
                   keep: tuple[str, ...] = ("airline_id",), distinct: bool = False,
                   unknown_km: float | None = None) -> DataFrame:
    """Edges ``src, dst, *keep, km`` with haversine length between both airports.

    An edge is dropped when either end has no coordinates (inner joins) or its
    length is NaN / not positive (self-loops, co-located airports).  With
    ``distinct`` parallel edges collapse first (same ends ⇒ same km).  With
    ``unknown_km`` such edges count as that long instead; only self-loops drop.
    """
    coords = unique_vertices(airports.select("id", "latitude", "longitude"))
    r = routes.select(F.col(src).alias("src"), F.col(dst).alias("dst"), *keep)
    if distinct:
        r = r.distinct()
    s = coords.select(F.col("id").alias("src"), F.col("latitude").alias("s_lat"), F.col("longitude").alias("s_lon"))
    d = coords.select(F.col("id").alias("dst"), F.col("latitude").alias("d_lat"), F.col("longitude").alias("d_lon"))
    km = haversine_km("s_lat", "s_lon", "d_lat", "d_lon")
    if unknown_km is not None:
        known = r.filter("src <> dst").join(s, "src", "left").join(d, "dst", "left").select("src", "dst", *keep, km.alias("km"))
        return known.withColumn("km", F.when(valid_distance("km"), F.col("km")).otherwise(F.lit(unknown_km)))
    return (
        r.join(s, "src").join(d, "dst")
        .select("src", "dst", *keep, km.alias("km"))
        .filter(valid_distance("km"))
    )


def out_degrees(edges: DataFrame) -> DataFrame:
    """Adjacency summary per source: out-degree, distinct targets, total km.

    Replaces a materialised adjacency list: neighbour sets are never gathered
    into one row, so a hub with millions of routes costs one partial aggregate.
    """
    aggs = [F.count(F.lit(1)).alias("out_degree"), F.count_distinct("dst").alias("n_targets")]
    if "km" in edges.columns:
        aggs.append(F.round(F.sum("km"), 4).alias("total_km"))
    return edges.groupBy("src").agg(*aggs)
