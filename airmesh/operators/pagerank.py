"""PageRank until convergence, and the top-k report.

Semantics: ``r(v) = reset + (1 - reset) · Σ_{u→v} r(u) · mult(u,v) / outdeg(u)``
over the directed multigraph (parallel edges weigh separately, dangling mass
is not redistributed), iterated from ``r = 1`` until the largest change of
any vertex is below ``tol``; the final ranks are rescaled to sum to |V|.

Plan per round: parallel edges are collapsed once into ``(src, dst, w)``;
ranks ⋈ weighted edges on the source (hub sources split out and broadcast,
see ``skew``) → partial/final aggregation by destination → left join back to
the vertex list.  The new rank table carries the previous rank so the
convergence test is one aggregate over the checkpointed table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import bucketed_table, cut_lineage, drop_table
from .graph import Graph, all_vertex_ids
from .skew import NOTHING_HOT, bucket_senders, fits_broadcast, join_vertex_values

# --- fixed value: reset probability of the workload ---
RESET_PROB = 0.15
# --- end fixed value ---
MAX_ITER = 1000


def weighted_out_edges(edges: DataFrame) -> DataFrame:
    """``src, dst, w`` with ``w = multiplicity / outdegree(src)``."""
    pairs = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("mult"))
    deg = edges.groupBy("src").agg(F.count(F.lit(1)).alias("outdeg"))
    return pairs.join(deg, "src").select("src", "dst", (F.col("mult") / F.col("outdeg")).alias("w"))


def pagerank(graph: Graph, tol: float | None = 1e-5, max_iter: int | None = None,
             reset: float = RESET_PROB) -> DataFrame:
    """``id, rank`` for every vertex (ghosts included), ranks summing to |V|.

    Stops when ``max |Δr| < tol`` or after ``max_iter`` rounds (at least one
    must be given; with both, whichever comes first).

    Every round is written under the reliable checkpoint folder and carries the
    previous rank: lineage is one round deep (an executor loss re-runs one
    round) and the convergence test is a scan.  The edge table never moves per
    round: when the rank table is under the broadcast threshold (size checked
    from the vertex count) it is broadcast to the edges; otherwise edges are a
    table bucketed on the source and each round's ranks a table bucketed on the
    id, so the join reads both sides in place.
    """
    if tol is None and max_iter is None:
        raise ValueError("give tol, max_iter or both")
    limit = max_iter if max_iter is not None else MAX_ITER
    spark = graph.edges.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = cut_lineage(all_vertex_ids(graph))
    n_vertices = ids.count()
    small = fits_broadcast(spark, n_vertices)
    if small:
        # ranks fit the broadcast threshold (checked): each round broadcasts them to the edges
        w_edges = cut_lineage(weighted_out_edges(graph.edges))
        keep = lambda df: cut_lineage(df, eager=tol is None)
    else:
        # edges bucketed on src once (hot senders' apart, in even parts); every round's ranks bucketed on id
        # the same way, so the contribution join reads both sides in place — edges are never shuffled again
        w_edges = bucket_senders(weighted_out_edges(graph.edges), "src", parts, "pr_edges")
        keep = lambda df: bucketed_table(df, "id", parts, "pr_ranks")
    ranks = keep(ids.select("id", F.lit(1.0).alias("rank"), F.lit(1.0).alias("prev")))
    for _ in range(limit):
        contrib = (
            (join_vertex_values(w_edges, "src", ranks.select("id", "rank"), NOTHING_HOT, broadcast_values=True) if small
             else w_edges.with_values(ranks.select("id", "rank")))
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum(F.col("rank") * F.col("w")).alias("s"))
        )
        new = ranks.select("id", F.col("rank").alias("prev")).join(contrib, "id", "left").select(
            "id", (F.lit(reset) + F.lit(1.0 - reset) * F.coalesce(F.col("s"), F.lit(0.0))).alias("rank"), "prev")
        previous, ranks = ranks, keep(new)
        if not small:
            drop_table(previous)
        if tol is not None:
            delta = ranks.agg(F.max(F.abs(F.col("rank") - F.col("prev")))).first()[0]
            if delta is None or delta < tol:
                break
    else:
        if max_iter is None:
            raise RuntimeError(f"PageRank did not converge to {tol} in {limit} rounds")
    total = ranks.agg(F.sum("rank")).first()[0]
    scale = n_vertices / total if total else 1.0
    return ranks.select("id", (F.col("rank") * F.lit(scale)).alias("rank"))


def pagerank_top(ranks: DataFrame, vertices: DataFrame, k: int = 10) -> DataFrame:
    """Top-k declared vertices by rank with 1-based position (ties → smaller id).

    ``orderBy().limit()`` plans as TakeOrderedAndProject; the window that
    numbers the rows only ever sees k rows.
    """
    top = ranks.join(vertices.select("id", "name", "country"), "id").orderBy(F.desc("rank"), "id").limit(k)
    w = Window.orderBy(F.desc("rank"), "id")
    return top.withColumn("position", F.row_number().over(w)).select("position", "id", "name", "country", "rank")
