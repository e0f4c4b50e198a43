"""Bounded path enumeration, itineraries, shortest / longest paths.

All searches share one design: a frontier DataFrame ``(origin, path, last,
km)`` is extended one hop at a time by an equi-join ``last = edge.src``.  The
edges it is joined with are those of that hop only: ``edges_toward`` gives, from
the targets backwards, the edges into a target and, for each number of hops
left, the edges whose end can still reach one, with a bound on the km from
there.  So a row that can't finish is never made, nothing is pruned after it
was built, and the last hop joins the edges into targets alone.  Sources and
targets are given as vertex sets, so no source × target pair table is ever
built; a request table ``(src, dst)`` is carried from the first hop when only
some pairs matter.

Shortest and longest paths are searched by branch and bound: the best-known km
of each (origin, target) bounds each hop, and a frontier row whose km plus the
bound on what is left can't reach the worst of its origin's best-known ones is
dropped as soon as it is made.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import path_text, text_path
from ..session import discard_tables, materialize


#: Paths that are labelled at a time.
LABEL_ROWS = 4_000_000


@dataclass(frozen=True)
class Toward:
    """Edges that lead to targets.

    ``last``: ``src, dst, w``, the edges into a target.  ``more[k]``: ``src,
    dst, w, rest``, the edges whose end reaches a target by 1..k further edges;
    ``rest`` is the least (or largest) weight of a walk that does.
    """

    last: DataFrame
    more: dict[int, DataFrame]


def edges_toward(edges: DataFrame, targets: DataFrame, max_hops: int, between: DataFrame | None = None,
                 longest: bool = False) -> Toward:
    """The edges (``src, dst, w``) that a search of ``max_hops`` hops into ``targets`` (``id``) may use.

    ``between`` (``id``) restricts where a path may go on; ends are free.  Each
    level is one join of the edges with a table of at most |V| bounds.
    """
    ends = targets.select(F.col("id").alias("dst")).distinct()
    last = materialize(edges.join(ends, "dst", "left_semi").select("src", "dst", "w"), "edges-into")
    inner = edges if between is None else edges.join(between.select(F.col("id").alias("dst")).distinct(), "dst", "left_semi")
    best = F.max if longest else F.min
    more: dict[int, DataFrame] = {}
    steps = last.select("src", F.col("w").alias("rest"))
    for k in range(1, max_hops):
        bound = steps.groupBy("src").agg(best("rest").alias("rest")).withColumnRenamed("src", "dst")
        level = inner.join(bound, "dst").select("src", "dst", "w", "rest")
        # the widest level is read by the first hop alone
        more[k] = materialize(level, "edges-toward") if k < max_hops - 1 else level
        steps = last.select("src", F.col("w").alias("rest")).unionByName(more[k].select("src", (F.col("w") + F.col("rest")).alias("rest")))
    return Toward(last, more)


def _weighted(edges: DataFrame, weight: str | None) -> DataFrame:
    w = F.col(weight) if weight else F.lit(0.0)
    return edges.select("src", "dst", w.cast("double").alias("w"))


def _start(sources: DataFrame) -> DataFrame:
    return sources.select(F.col("id").alias("origin"), F.array("id").alias("path"), F.col("id").alias("last"), F.lit(0.0).alias("km")).distinct()


def _grown(frontier: DataFrame, steps: DataFrame, *also: str) -> DataFrame:
    """The simple paths of ``frontier`` lengthened by an edge of ``steps``, with its columns ``also``."""
    return (frontier.join(steps, frontier["last"] == steps["src"]).filter(~F.array_contains("path", F.col("dst")))
            .select("origin", F.array_append("path", F.col("dst")).alias("path"), F.col("dst").alias("last"),
                    (F.col("km") + F.col("w")).alias("km"), *also))


def _hits(frontier: DataFrame, toward: Toward, hops: int) -> DataFrame:
    return _grown(frontier, toward.last).select("origin", F.col("last").alias("target"), F.lit(hops).alias("hops"), "path", "km")


def simple_paths(edges: DataFrame, sources: DataFrame, targets: DataFrame, max_hops: int = 3,
                 weight: str | None = "km") -> DataFrame:
    """All simple paths (no repeated vertex) from a source to a target, 1..max_hops edges.

    ``edges``: ``src, dst[, weight]``; ``sources`` / ``targets``: column ``id``.
    Returns ``origin, target, hops, path (array<bigint>), km``.
    A path ends where it first meets its target; since paths are simple, a path
    that reached its target can never come back to it, so every result is
    exactly a simple path ending at the target.
    """
    toward = edges_toward(_weighted(edges, weight), targets, max_hops)
    frontier = _start(sources)
    out = _hits(frontier, toward, 1)
    for hop in range(1, max_hops):
        frontier = _grown(frontier, toward.more[max_hops - hop])
        if hop < max_hops - 1:
            frontier = materialize(frontier, "frontier")  # read by this hop's hits and by the next hop
        out = out.unionByName(_hits(frontier, toward, hop + 1))
    return out


def _order(longest: bool) -> list[Column]:
    """What best paths are the least by: km (falling for the longest), then the path's text."""
    km = -F.col("km") if longest else F.col("km")
    return [km.alias("k"), path_text("path").alias("t")]


def _best(rows: DataFrame, longest: bool) -> DataFrame:
    """One row of each (origin, target): the shortest (or longest) path.

    The aggregate keeps one candidate in each partial buffer, so a pair with
    millions of candidate paths never gathers them in one place.
    """
    least = F.min(F.struct(*_order(longest), "hops")).alias("b")  # km and path are in what it is ordered by
    km = -F.col("b.k") if longest else F.col("b.k")
    return rows.groupBy("origin", "target").agg(least).select("origin", "target", "b.hops", text_path("b.t").alias("path"), km.alias("km"))


def _in_bounds(frontier: DataFrame, hits: DataFrame, n_targets: int, longest: bool) -> DataFrame:
    """``frontier`` (with ``rest``) without rows that can't better any best-known path of their origin.

    ``hits`` are the paths to targets found so far.  An origin bounds its rows
    once it has a path to each of the ``n_targets`` targets: by the worst of
    their best.  ``rest`` is no worse than what any continuation adds, so no
    best path is lost; ties stay.
    """
    known = hits.groupBy("origin", "target").agg((F.max if longest else F.min)("km").alias("km"))
    limits = (known.groupBy("origin").agg((F.min if longest else F.max)("km").alias("worst"), F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= n_targets).select("origin", "worst"))
    reach = F.col("km") + F.col("rest")
    slack = F.lit(1e-9) * F.abs("worst")  # sums taken in another order
    may = reach >= F.col("worst") - slack if longest else reach <= F.col("worst") + slack
    return frontier.join(limits, "origin", "left").filter(F.col("worst").isNull() | may).drop("worst", "rest")


def shortest_paths(edges: DataFrame, sources: DataFrame, targets: DataFrame, max_hops: int = 3,
                   weight: str = "km") -> DataFrame:
    """Per (origin, target) the shortest path of 1..max_hops edges; ties break on the path text.

    Edge weights are positive, so the best path of h edges to a vertex extends
    a best path of h - 1 edges that avoids it: after each hop only the best
    row of each (origin, last) is kept, and only if no path of fewer hops got
    there for less — |origins| · |V| rows at most — instead of every simple
    path.  Returns ``origin, target, hops, path, km``.
    """
    return _searched(edges, sources, targets, max_hops, weight, longest=False)


def longest_paths(edges: DataFrame, sources: DataFrame, targets: DataFrame, max_hops: int = 3,
                  weight: str = "km") -> DataFrame:
    """Per (origin, target) the longest simple path of 1..max_hops edges; ties break on the path text.

    Longest paths don't extend longest paths, so every simple path that its
    bound lets through is followed.  Returns ``origin, target, hops, path, km``.
    """
    return _searched(edges, sources, targets, max_hops, weight, longest=True)


def _searched(edges: DataFrame, sources: DataFrame, targets: DataFrame, max_hops: int, weight: str, longest: bool) -> DataFrame:
    edges, targets = _weighted(edges, weight).filter("src <> dst"), targets.select("id").distinct()
    toward = edges_toward(edges, targets, max_hops, longest=longest)
    n_targets = targets.count()
    # one best row of each vertex before the last hop pays if that hop has more edges than vertices to leave from
    merged_last = not longest and toward.last.count() > edges.agg(F.approx_count_distinct("src")).first()[0]
    frontier = _start(sources)
    hits = _hits(frontier, toward, 1)
    before = None  # the best row of each (origin, last) of fewer hops
    for hop in range(1, max_hops):
        frontier = _in_bounds(_grown(frontier, toward.more[max_hops - hop], "rest"), hits, n_targets, longest)
        if not longest and (hop < max_hops - 1 or merged_last):
            frontier = _undominated(frontier, before)
        if hop < max_hops - 1:
            frontier = materialize(frontier, "frontier")  # read by its hits, their bounds and the next hop
            before = frontier if before is None else before.unionByName(frontier)
        hits = hits.unionByName(_hits(frontier, toward, hop + 1))
    return _best(hits, longest)


def _undominated(frontier: DataFrame, before: DataFrame | None) -> DataFrame:
    """The best row of each (origin, last) of ``frontier``, if better than all rows of ``before`` there."""
    key = F.struct(*_order(longest=False))
    rows = frontier.withColumn("new", F.lit(True))
    if before is not None:
        rows = rows.unionByName(before.select(*frontier.columns).withColumn("new", F.lit(False)))
    best = rows.groupBy("origin", "last").agg(F.min(F.when(F.col("new"), key)).alias("b"), F.min(F.when(~F.col("new"), key)).alias("old"))
    return best.filter(F.col("b").isNotNull() & (F.col("old").isNull() | (F.col("b") < F.col("old")))).select("origin", text_path("b.t").alias("path"), "last", F.col("b.k").alias("km"))


def request_paths(edges: DataFrame, requests: DataFrame, max_hops: int = 3, weight: str = "km") -> DataFrame:
    """All simple paths of 1..max_hops edges from ``src`` to ``dst`` of each row of ``requests``.

    The requested pair is carried from the first hop: a frontier row knows its
    target, and is kept only while that target is within the hops left of it.
    Returns ``origin, target, hops, path, km``; a request asked twice counts once.
    """
    e = edges.select("src", "dst", F.col(weight).cast("double").alias("w"))
    asked = materialize(requests.select(F.col("src").alias("origin"), F.col("dst").alias("target")).distinct(), "requests")
    reach = [materialize(asked.select("target", F.col("target").alias("id")).distinct(), "reach")]
    for _ in range(max_hops - 1):
        step = e.join(reach[-1].withColumnRenamed("id", "dst"), "dst").select("target", F.col("src").alias("id"))
        reach.append(materialize(reach[0].union(step).distinct(), "reach"))
    frontier = asked.select("origin", "target", F.array("origin").alias("path"), F.col("origin").alias("last"), F.lit(0.0).alias("km"))
    hits = []
    for hop in range(1, max_hops + 1):
        frontier = materialize(
            frontier.join(e, frontier["last"] == e["src"]).filter(~F.array_contains("path", F.col("dst")))
            .select("origin", "target", F.array_append("path", F.col("dst")).alias("path"), F.col("dst").alias("last"),
                    (F.col("km") + F.col("w")).alias("km"))
            .join(reach[max_hops - hop].withColumnRenamed("id", "last"), ["target", "last"], "left_semi"), "frontier")
        hits.append(frontier.filter(F.col("last") == F.col("target")).select("origin", "target", F.lit(hop).alias("hops"), "path", "km"))
        frontier = frontier.filter(F.col("last") != F.col("target"))
    out = hits[0]
    for h in hits[1:]:
        out = out.unionByName(h)
    return out


def restrict_to_requests(paths: DataFrame, requests: DataFrame) -> DataFrame:
    """Keep paths whose (origin, target) is in ``requests(src, dst)``."""
    req = requests.select(F.col("src").alias("origin"), F.col("dst").alias("target")).distinct()
    return paths.join(req, ["origin", "target"], "left_semi")


def extreme_paths(paths: DataFrame, longest: bool = False) -> DataFrame:
    """Per (origin, target): the path with the smallest (or largest) total km.

    Ties break on the path text, so the choice is deterministic.
    """
    return _best(paths, longest)


def label_paths(paths: DataFrame, vertices: DataFrame, unknown: str = "???") -> DataFrame:
    """Add ``labels``: ``'id:name -> id:name …'`` (``???`` for an id without a row).

    Each path is exploded into at most ``max_hops + 1`` positions, looked up
    with a left join and re-assembled in position order, grouping by the
    path's row (a group never holds more than one path's positions).  Other
    columns go with the first position only.  About ``LABEL_ROWS`` paths at a
    time are labelled and written, so that the exchanges of all don't exist at
    once.
    """
    names = vertices.groupBy("id").agg(F.min("name").alias("name"))
    cols = paths.columns
    # equal paths stay one row each: the row number is written, so that it is the same wherever it is read
    numbered = materialize(paths.withColumn("_row", F.monotonically_increasing_id()), "paths")
    n = numbered.count()
    if n > LABEL_ROWS:
        names = materialize(names, "names")
    others = [c for c in cols if c != "path"]
    slices = []
    for k in range(rounds := max(1, -(-n // LABEL_ROWS))):
        part = numbered if rounds == 1 else numbered.filter(F.pmod(F.xxhash64("_row"), F.lit(rounds)) == k)
        exploded = part.select("_row", F.struct(*others).alias("_others"), F.posexplode("path").alias("_pos", "id"))
        exploded = exploded.withColumn("_others", F.when(F.col("_pos") == 0, F.col("_others")))
        at = F.collect_list(F.struct("_pos", "id", "name"))
        whole = (exploded.join(names, "id", "left").groupBy("_row")
                 .agg(F.array_sort(at).alias("_at"), F.max_by("_others", -F.col("_pos")).alias("_others")))
        labels = F.transform("_at", lambda s: F.concat(s["id"].cast("string"), F.lit(":"), F.coalesce(s["name"], F.lit(unknown))))
        named = {"path": F.col("_at.id")} | {c: F.col("_others").getField(c) for c in others}
        whole = whole.select(*(named[c].alias(c) for c in cols), F.array_join(labels, " -> ").alias("labels"))
        slices.append(whole if rounds == 1 else materialize(whole, "labels"))
    if rounds == 1:
        return slices[0]
    discard_tables(numbered)
    discard_tables(names)
    return reduce(DataFrame.unionByName, slices)


def itineraries(vertices: DataFrame, edges: DataFrame, src_country: str, dst_country: str,
                max_stops: int = 2, strict: bool = True) -> DataFrame:
    """Itineraries with 0..max_stops interior stops from one country to another.

    ``vertices``: ``id, country``; ``edges``: ``src, dst`` (collapsed to one row
    per pair).  Returns ``origin, destination, stops, path``.

    strict=True  (pattern semantics): every vertex on the path exists in the
                 vertex table and all vertices are pairwise distinct.
    strict=False (self-join semantics): interior stops differ from both ends,
                 but not necessarily from each other, and need not exist in the
                 vertex table; ends are not compared with each other.
    """
    return _itineraries(vertices.select("id", "country").distinct(), edges.select("src", "dst").distinct(), src_country, dst_country, max_stops, strict)


def _itineraries(v: DataFrame, e: DataFrame, src_country: str, dst_country: str, max_stops: int, strict: bool) -> DataFrame:
    a = v.filter(F.col("country") == src_country).select("id")
    b = v.filter(F.col("country") == dst_country).select("id")
    toward = edges_toward(e.withColumn("w", F.lit(0.0)), b, max_stops + 1, between=v if strict else None)

    def step(frontier: DataFrame, steps: DataFrame, last: bool) -> DataFrame:
        grown = frontier.join(steps, frontier["last"] == steps["src"])
        if strict:
            own = ~F.array_contains("path", F.col("dst"))
        elif last:  # the stops differ from the end; a route without stops may be any
            own = ~F.array_contains(F.slice("path", 2, F.greatest(F.size("path") - 1, F.lit(1))), F.col("dst"))
        else:
            own = F.col("dst") != F.col("origin")
        return grown.filter(own).select("origin", F.array_append("path", F.col("dst")).alias("path"), F.col("dst").alias("last"))

    frontier = a.select(F.col("id").alias("origin"), F.array(F.col("id")).alias("path"), F.col("id").alias("last"))
    out = None
    for stops in range(max_stops + 1):
        done = step(frontier, toward.last, last=True).select(
            "origin", F.col("last").alias("destination"), F.lit(stops).alias("stops"), path_text("path").alias("path"))
        out = done if out is None else out.unionByName(done)
        if stops < max_stops:
            frontier = step(frontier, toward.more[max_stops - stops], last=False)
            if stops < max_stops - 1:
                frontier = materialize(frontier, "frontier")  # read by its own ends and by the next stop
    return out


def round_trip_itineraries(vertices: DataFrame, edges: DataFrame, country_a: str, country_b: str,
                           max_stops: int = 2, strict: bool = True) -> DataFrame:
    """Both directions, one row per distinct (path, stops)."""
    v, e = vertices.select("id", "country").distinct(), materialize(edges.select("src", "dst").distinct(), "edges")
    there = _itineraries(v, e, country_a, country_b, max_stops, strict)
    back = _itineraries(v, e, country_b, country_a, max_stops, strict)
    return there.unionByName(back).distinct()
