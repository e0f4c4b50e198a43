"""Synchronous label propagation (community detection).

Every vertex starts with its own id as label.  Each round every edge carries
the label of each endpoint to the other one (parallel edges vote separately,
edge direction ignored); a vertex adopts the label with most votes — ties go
to the smallest label — and a vertex that received no vote keeps its label.
The result is defined by the number of rounds: on bipartite pieces labels can
swap forever (one edge 10–20 alternates every round), so ``max_steps`` is part
of the answer.  A round that changes nothing ends the loop early, which is
exact because rounds are deterministic.

Plan per round: labels ⋈ directed vote edges on the sender (hub senders split
out and broadcast) → partial/final count by (receiver, label) → max of
(votes, -label) per receiver → left join to the previous labels.

Rounds are incremental: a vertex none of whose neighbours changed gets the votes
of the round before and keeps its label.  Once few labels change, only the
receivers of a changed sender are voted on again; the vote edges of all others
are dropped at the scan, before any shuffle.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bucketed_table, cut_lineage, drop_table
from .graph import Graph, all_vertex_ids
from .skew import NOTHING_HOT, bucket_senders, fits_broadcast, join_vertex_values

MAX_STEPS = 100
#: Rounds are restricted to the receivers of changed senders from this share of changed labels down.
CHANGED_SHARE = 0.25


def voted_again(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``receiver``: the vertices that a sender votes for whose label changed in the last round.

    The caller has checked that the changed vertices may be broadcast.
    """
    changed = labels.filter(F.col("label") != F.col("prev")).select(F.col("id").alias("sender"))
    return edges.join(F.broadcast(changed), "sender", "left_semi").select("receiver").distinct()


def label_propagation(graph: Graph, max_steps: int = MAX_STEPS, vote_rows: list[int] | None = None) -> DataFrame:
    """``id, label`` for every vertex (ghosts included).

    Every round is written under the reliable checkpoint folder (labels are
    broadcast to the vote edges when their size — checked from the vertex count —
    is under the broadcast threshold; otherwise both are tables bucketed on the
    vertex id, so the vote join never re-shuffles edges), together with the two
    previous labels, so lineage is one round deep and a single aggregate
    tells whether the labels reached a fixed point or a two-round cycle (then
    the state at ``max_steps`` follows from the parity of the remaining rounds
    — exact, since rounds are deterministic).

    The receivers to vote on again are broadcast to the vote edges where their
    number is under the broadcast threshold; beyond it a round votes on all.
    ``vote_rows``, if given, gets the number of vote edges of each round.
    """
    spark = graph.edges.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = cut_lineage(all_vertex_ids(graph))
    n_vertices = ids.count()
    small = fits_broadcast(spark, n_vertices)
    e = graph.edges.select("src", "dst")
    votes = (
        e.select(F.col("src").alias("sender"), F.col("dst").alias("receiver"))
        .union(e.select(F.col("dst").alias("sender"), F.col("src").alias("receiver")))
        .groupBy("sender", "receiver").agg(F.count(F.lit(1)).alias("mult"))
    )
    if small:
        # labels fit the broadcast threshold (checked): each round broadcasts them to the vote edges
        votes_edges = cut_lineage(votes)
        all_edges = votes_edges
        keep = lambda df: cut_lineage(df, eager=False)
    else:
        # vote edges bucketed on the sender once (hot senders' apart, in even parts), every round's labels
        # bucketed on id the same way: the vote join reads both sides in place, edges are never shuffled again
        votes_edges = bucket_senders(votes, "sender", parts, "lpa_edges")
        all_edges = votes_edges.cold if votes_edges.hot_edges is None else votes_edges.cold.unionByName(votes_edges.hot_edges)
        keep = lambda df: bucketed_table(df, "id", parts, "lpa_labels")
    labels = keep(ids.select("id", F.col("id").alias("label"), F.col("id").alias("prev"),
                             F.lit(None).cast("long").alias("prev2")))
    n_changed = n_vertices
    for step in range(1, max_steps + 1):
        again = None
        if n_changed <= CHANGED_SHARE * n_vertices and fits_broadcast(spark, n_changed):
            again = voted_again(all_edges, labels)
            if not small:
                again = cut_lineage(again)
                again = again if fits_broadcast(spark, again.count()) else None
        sent = votes_edges
        if again is not None:
            only = lambda edges: edges and edges.join(F.broadcast(again), "receiver", "left_semi")  # noqa: B023, E731
            sent = only(votes_edges) if small else replace(votes_edges, cold=only(votes_edges.cold), hot_edges=only(votes_edges.hot_edges))
        current = labels.select("id", "label")
        votes = join_vertex_values(sent, "sender", current, NOTHING_HOT, broadcast_values=True) if small else sent.with_values(current)
        if vote_rows is not None:
            vote_rows.append(votes.count())
        tallies = votes.groupBy("receiver", "label").agg(F.sum("mult").alias("votes"))
        winner = tallies.groupBy(F.col("receiver").alias("id")).agg(
            F.max(F.struct(F.col("votes").alias("votes"), (-F.col("label")).alias("neg"))).alias("b"))
        new = labels.select("id", F.col("label").alias("prev"), F.col("prev").alias("prev2")).join(
            winner, "id", "left").select(
            "id", F.coalesce(-F.col("b.neg"), F.col("prev")).alias("label"), "prev", "prev2")
        previous, labels = labels, keep(new)
        if not small:
            drop_table(previous)
        # one job: did anything change since the last round / since two rounds ago?
        diff = labels.agg(
            F.coalesce(F.sum((F.col("label") != F.col("prev")).cast("long")), F.lit(0)).alias("d1"),
            F.max((~F.col("label").eqNullSafe(F.col("prev2"))).cast("int")).alias("d2"),
        ).first()
        n_changed = diff.d1
        if not n_changed:  # fixed point: every later round is identical
            break
        if step >= 2 and not diff.d2:
            # period two from here on: the answer at max_steps is fixed by parity
            if (max_steps - step) % 2:
                return labels.select("id", F.col("prev").alias("label"))
            break
    return labels.select("id", "label")
