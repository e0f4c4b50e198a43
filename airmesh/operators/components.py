"""Connected components and cluster reports.

Connected components use the alternating *large-star* / *small-star*
algorithm (Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii, "Connected
Components in MapReduce and Beyond", SoCC 2014): O(log² n) rounds, each a
couple of aggregations and joins over the edge table, instead of the
diameter-many rounds of min-label propagation.  Edge direction is ignored;
the component label is the smallest vertex id in the component, ghosts
(ids only present in edges) included.  Every round's edge set is written to
the reliable checkpoint folder, so lineage stays one round deep and a lost
executor only re-runs the current round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .graph import Graph, all_vertex_ids
from .skew import find_hot_keys, join_vertex_values

MAX_ROUNDS = 200


def _canonical(edges: DataFrame) -> DataFrame:
    """Undirected, loop-free, one row per pair: ``a > b``."""
    return (
        edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )


def _large_star(e: DataFrame, n_edges: int) -> DataFrame:
    """For every u: link each larger neighbour v to m(u) = min(Γ(u) ∪ {u})."""
    sym = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    mins = sym.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
    mins = mins.select(F.col("u").alias("id"), F.least("u", "m").alias("m"), "degree")
    hot = find_hot_keys(mins, 2 * n_edges, degree="degree")
    up = sym.filter(F.col("v") > F.col("u"))
    linked = join_vertex_values(up, "u", mins.select("id", "m"), hot)
    return linked.select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame, n_edges: int) -> DataFrame:
    """For every u: link u and its smaller neighbours to the smallest of them."""
    mins = e.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
    hot = find_hot_keys(mins.withColumnRenamed("a", "id"), n_edges, degree="degree")
    linked = join_vertex_values(e, "a", mins.select(F.col("a").alias("id"), "m"), hot)
    children = linked.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    parents = mins.select("a", F.col("m").alias("b"))
    return children.union(parents).distinct()


def _star_check(e: DataFrame) -> tuple[bool, int]:
    """(is a star forest, number of edges) in one aggregate.

    Star forest: every vertex points at one parent and no parent has a parent.
    """
    roles = e.select(F.col("a").alias("v"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
        e.select(F.col("b").alias("v"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    per = roles.groupBy("v").agg(F.sum("child").alias("c"), F.max("parent").alias("p"))
    bad = ((F.col("c") > 1) | ((F.col("c") >= 1) & (F.col("p") == 1))).cast("int")
    row = per.agg(F.coalesce(F.max(bad), F.lit(0)).alias("bad"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    return row.bad == 0, int(row.n)


def connected_components(graph: Graph, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``id, component`` for every vertex (declared and ghost).

    Each round's edge set is checkpointed lazily: the count / star check that
    the next step needs anyway is the action that computes and writes it.
    """
    e = cut_lineage(_canonical(graph.edges))
    n = e.count()
    for _ in range(max_rounds):
        large = cut_lineage(_large_star(e, n), eager=False)
        n_large = large.count()
        e = cut_lineage(_small_star(large, n_large), eager=False)
        done, n = _star_check(e)
        if done:
            break
    else:
        raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
    ids = all_vertex_ids(graph)
    return ids.join(e.withColumnRenamed("a", "id"), "id", "left").select(
        "id", F.coalesce(F.col("b"), F.col("id")).alias("component"))


def component_sizes(assignment: DataFrame, label: str = "component") -> DataFrame:
    """``component, size`` (partial aggregation: a giant component costs one row per task)."""
    return assignment.groupBy(label).agg(F.count(F.lit(1)).alias("size"))


def largest_component(assignment: DataFrame, label: str = "component") -> DataFrame:
    """One row: the largest component, ties → smallest id."""
    sizes = component_sizes(assignment, label)
    best = F.max(F.struct(F.col("size").alias("size"), (-F.col(label)).alias("neg")))
    return sizes.agg(best.alias("b")).select((-F.col("b.neg")).alias(label), F.col("b.size").alias("size"))


def _first_members(members: DataFrame, label: str, per_group: int) -> DataFrame:
    """First ``per_group`` members (by id) of each group — rank-and-cut, never a whole group.

    Spark plans ``row_number() <= n`` as a window group limit, so a giant
    group only carries n rows per partition past the partial stage.
    """
    w = Window.partitionBy(label).orderBy("id")
    return members.withColumn("member_rank", F.row_number().over(w)).filter(F.col("member_rank") <= per_group)


def component_report(assignment: DataFrame, vertices: DataFrame, min_size: int = 5, top_components: int = 10,
                     per_component: int = 10, label: str = "component") -> DataFrame:
    """Components sized *after* the attribute join (ghosts excluded), size ≥ min_size,
    the ``top_components`` smallest component ids, first ``per_component`` members each.

    Returns ``component, size, member_rank, id, name, country``.
    """
    members = assignment.join(vertices.select("id", "name", "country"), "id")
    sizes = component_sizes(members, label).filter(F.col("size") >= min_size)
    chosen = sizes.orderBy(label).limit(top_components)
    picked = members.join(F.broadcast(chosen), label)  # at most top_components rows
    return _first_members(picked, label, per_component).select(
        label, "size", "member_rank", "id", "name", "country")


def small_clusters(assignment: DataFrame, vertices: DataFrame, min_size: int = 2, per_cluster: int = 10,
                   label: str = "component") -> DataFrame:
    """Clusters sized *before* the attribute join (ghosts count), the single largest
    dropped, size ≥ min_size; first ``per_cluster`` members with attributes.

    ``size`` counts every member (ghosts too) and drives the filter; ``n_known``
    counts members with an attribute row, the ones listed.
    Returns ``<label>, size, n_known, member_rank, id, name, country``.
    """
    sizes = component_sizes(assignment, label)
    largest = largest_component(assignment, label).select(F.col(label).alias("_largest"))
    # the giant cluster goes by a scalar comparison, before any row of it is shuffled
    giant = largest.agg(F.max("_largest")).scalar()
    keep = sizes.filter((F.col("size") >= min_size) & (F.col(label) != giant))
    members = assignment.filter(F.col(label) != giant).join(keep, label).join(vertices.select("id", "name", "country"), "id")
    known = members.groupBy(label).agg(F.count(F.lit(1)).alias("n_known"))
    return _first_members(members, label, per_cluster).join(known, label).select(
        label, "size", "n_known", "member_rank", "id", "name", "country")
