"""Iterative graph queries: components, PageRank, label propagation, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import communities, components, graph, pagerank
from ..sources import standins
from .registry import query
from .sqltext import AIRPORT, ROUTE, ORDER_ROUTE

TOL = 1e-5
LPA_STEPS = 100


def _rec(*ctes: str, body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


_IDS = "ids AS (SELECT id FROM airport UNION SELECT src_id FROM route UNION SELECT dest_id FROM route)"
_CC = """ue AS (SELECT src_id AS a, dest_id AS b FROM route UNION SELECT dest_id, src_id FROM route),
reach(v, r) AS (SELECT id, id FROM ids UNION SELECT reach.v, ue.b FROM reach JOIN ue ON reach.r = ue.a),
cc AS (SELECT v AS id, min(r) AS component FROM reach GROUP BY v)"""
_LP = f"""ve AS (SELECT sender, receiver, count(*) AS mult FROM (
    SELECT src_id AS sender, dest_id AS receiver FROM route UNION ALL SELECT dest_id, src_id FROM route) t
  GROUP BY sender, receiver),
lp(it, id, label) AS (
  SELECT 0, id, id FROM ids
  UNION ALL
  SELECT l.it + 1, l.id, coalesce(w.label, l.label) FROM lp l LEFT JOIN (
    SELECT receiver, label FROM (
      SELECT ve.receiver, q.label,
             row_number() OVER (PARTITION BY ve.receiver ORDER BY sum(ve.mult) DESC, q.label ASC) AS rn
      FROM lp q JOIN ve ON q.id = ve.sender GROUP BY ve.receiver, q.label) t WHERE rn = 1) w
  ON w.receiver = l.id
  WHERE l.it < {LPA_STEPS}),
cc AS (SELECT id, label AS community FROM lp WHERE it = {LPA_STEPS})"""
_PR = f"""od AS (SELECT src_id, count(*) AS d FROM route GROUP BY src_id),
w AS (SELECT r.src_id AS src, r.dest_id AS dst, 1.0 / od.d AS w FROM route r JOIN od USING (src_id)),
pr(it, id, rank, delta) AS (
  SELECT 0, id, 1.0::DOUBLE, 1e300::DOUBLE FROM ids
  UNION ALL
  SELECT it + 1, id, nr, max(abs(nr - rank)) OVER () FROM (
    SELECT p.it, p.id, p.rank, 0.15 + 0.85 * coalesce(c.s, 0.0) AS nr
    FROM pr p LEFT JOIN (SELECT w.dst, sum(q.rank * w.w) AS s FROM pr q JOIN w ON q.id = w.src GROUP BY w.dst) c
      ON c.dst = p.id
    WHERE p.delta >= {TOL}) x),
fin AS (SELECT id, rank FROM pr WHERE it = (SELECT max(it) FROM pr)),
prs AS (SELECT id, rank * (SELECT count(*) FROM ids) / (SELECT sum(rank) FROM fin) AS rank FROM fin)"""


def _sparse_graph(spark, sf_dir):
    return graph.build_graph(standins.airports(spark, sf_dir), standins.order_routes(spark, sf_dir))


def _dense_graph(spark, sf_dir):
    return graph.build_graph(standins.airports(spark, sf_dir), standins.routes(spark, sf_dir))


# ---------------------------------------------------------------- connected components
@query("connected_components", _rec(AIRPORT, ORDER_ROUTE, _IDS, _CC, body="SELECT id, component FROM cc"))
def q_connected_components(spark, sf_dir):
    return components.connected_components(_sparse_graph(spark, sf_dir))


@query("component_sizes", _rec(AIRPORT, ORDER_ROUTE, _IDS, _CC,
                               body="SELECT component, count(*) AS size FROM cc GROUP BY component"))
def q_component_sizes(spark, sf_dir):
    return components.component_sizes(components.connected_components(_sparse_graph(spark, sf_dir)))


@query("largest_component", _rec(AIRPORT, ORDER_ROUTE, _IDS, _CC, body="""SELECT component, count(*) AS size
FROM cc GROUP BY component ORDER BY size DESC, component LIMIT 1"""))
def q_largest_component(spark, sf_dir):
    return components.largest_component(components.connected_components(_sparse_graph(spark, sf_dir)))


_REPORT = """m AS (SELECT cc.component, a.id, a.name, a.country FROM cc JOIN airport a ON a.id = cc.id),
sz AS (SELECT component, count(*) AS size FROM m GROUP BY component HAVING count(*) >= 5),
top AS (SELECT * FROM sz ORDER BY component LIMIT 10),
ranked AS (SELECT m.*, top.size, CAST(row_number() OVER (PARTITION BY m.component ORDER BY m.id) AS INTEGER) AS member_rank
           FROM m JOIN top ON top.component = m.component)"""


@query("component_report", _rec(AIRPORT, ORDER_ROUTE, _IDS, _CC, _REPORT, body="""
SELECT component, size, member_rank, id, name, country FROM ranked WHERE member_rank <= 10"""))
def q_component_report(spark, sf_dir):
    g = _sparse_graph(spark, sf_dir)
    return components.component_report(components.connected_components(g), g.vertices)


def _small_sql(label: str) -> str:
    return f"""sz AS (SELECT {label}, count(*) AS size FROM cc GROUP BY {label}),
big AS (SELECT {label} FROM sz ORDER BY size DESC, {label} LIMIT 1),
keep AS (SELECT * FROM sz WHERE size >= 2 AND {label} NOT IN (SELECT {label} FROM big)),
m AS (SELECT cc.{label}, keep.size, a.id, a.name, a.country
      FROM cc JOIN keep ON keep.{label} = cc.{label} JOIN airport a ON a.id = cc.id),
kn AS (SELECT {label}, count(*) AS n_known FROM m GROUP BY {label}),
ranked AS (SELECT m.*, kn.n_known, CAST(row_number() OVER (PARTITION BY m.{label} ORDER BY m.id) AS INTEGER) AS member_rank
           FROM m JOIN kn ON kn.{label} = m.{label})"""


@query("small_components", _rec(AIRPORT, ORDER_ROUTE, _IDS, _CC, _small_sql("component"), body="""
SELECT component, size, n_known, member_rank, id, name, country FROM ranked WHERE member_rank <= 10"""))
def q_small_components(spark, sf_dir):
    g = _sparse_graph(spark, sf_dir)
    return components.small_clusters(components.connected_components(g), g.vertices)


# ---------------------------------------------------------------- label propagation
@query("label_propagation", _rec(AIRPORT, ORDER_ROUTE, _IDS, _LP, body="SELECT id, community AS label FROM cc"))
def q_label_propagation(spark, sf_dir):
    return communities.label_propagation(_sparse_graph(spark, sf_dir), LPA_STEPS)


@query("small_communities", _rec(AIRPORT, ORDER_ROUTE, _IDS, _LP, _small_sql("community"), body="""
SELECT community, size, n_known, member_rank, id, name, country FROM ranked WHERE member_rank <= 10"""))
def q_small_communities(spark, sf_dir):
    g = _sparse_graph(spark, sf_dir)
    labels = communities.label_propagation(g, LPA_STEPS).withColumnRenamed("label", "community")
    return components.small_clusters(labels, g.vertices, label="community")


# ---------------------------------------------------------------- PageRank
@query("pagerank", _rec(AIRPORT, ROUTE, _IDS, _PR, body="SELECT id, round(rank, 6) AS rank FROM prs"))
def q_pagerank(spark, sf_dir):
    ranks = pagerank.pagerank(_dense_graph(spark, sf_dir), tol=TOL)
    return ranks.select("id", F.round("rank", 6).alias("rank"))


@query("pagerank_top", _rec(AIRPORT, ROUTE, _IDS, _PR, body="""
SELECT CAST(row_number() OVER (ORDER BY round(p.rank, 9) DESC, p.id) AS INTEGER) AS position, p.id, a.name, a.country,
       round(p.rank, 6) AS rank
FROM prs p JOIN airport a ON a.id = p.id ORDER BY round(p.rank, 9) DESC, p.id LIMIT 10"""))
def q_pagerank_top(spark, sf_dir):
    g = _dense_graph(spark, sf_dir)
    ranks = pagerank.pagerank(g, tol=TOL).withColumn("rank", F.round("rank", 9))
    top = pagerank.pagerank_top(ranks, g.vertices)
    return top.withColumn("rank", F.round("rank", 6))
