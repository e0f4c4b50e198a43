"""Exact top-k search by inner product in M-trees of bounded size.

Vectors become whole numbers (floor(64 * x)).  With R the largest norm and one
more coordinate sqrt(R * R - |x|^2) for a stored vector, 0 for a query, the
squared distance is |q|^2 + R * R - 2 <q, x>: the largest products are the
nearest points of a metric space, and the triangle inequality may prune.

* At most ``PIVOTS`` routing objects (a bounded sample of the vectors) part the
  space; each vector goes to the nearest.  What one gets is cut into subtrees of
  about ``TREE_ROWS`` rows, however many rows (or copies of one vector) there are.
* A subtree has leaf pages of at most ``PAGE_ROWS`` entries, each with a routing
  object, a covering radius and, for every entry, the distance to that object.
* Every query is first searched in one subtree of its own routing object; its
  k-th product there bounds the search.  It then goes only to subtrees whose
  ball (routing object, radius) reaches within that bound.
* In a subtree pages are read best first, by the least distance that their ball
  allows, until that exceeds the bound; within a page, entries whose stored
  distance to the routing object differs from the query's by more than the
  bound are passed over without computing their product.

Products are whole numbers, so results are exact; bounds have a slack for
rounding.  The answers of all subtrees are merged by one windowed top k.

Defined results: vectors (as queries too) that are null or hold null or
non-finite components, and rows without an id, take no part; vectors of unlike
length are filled up with zeros; ties go to the smaller id (rows that repeat an
id are different rows, each its own query); a query with fewer than k
candidates gets them all; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_rows, ship_package, stored

PIVOTS = 64
TREE_ROWS = 4096
PAGE_ROWS = 128
QUERY_ROWS = 1024
SCALE = 64


def usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return embedding.isNotNull() & finite


def whole_numbers(embedding: Column) -> Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def distances(points: np.ndarray, others: np.ndarray, radius: float) -> np.ndarray:
    """Distances of the stored ``points`` to the stored ``others`` (rows), with their further coordinate."""
    a, b = (points * points).sum(1), (others * others).sum(1)
    extra = np.sqrt(np.maximum(radius - a, 0))[:, None] * np.sqrt(np.maximum(radius - b, 0))[None]
    return np.sqrt(np.maximum(a[:, None] + b[None] - 2 * points @ others.T + 2 * radius - a[:, None] - b[None] - 2 * extra, 0))


def query_distances(queries: np.ndarray, others: np.ndarray, radius: float) -> np.ndarray:
    return np.sqrt(np.maximum((queries * queries).sum(1)[:, None] + radius - 2 * queries @ others.T, 0))


class Subtree:
    """Pages over the rows of one group: routing objects, radii, entries with their parent distances."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, points: np.ndarray, radius: float):
        self.radius = radius
        order = np.argsort(rows)  # the same tree in whatever order the rows came
        ids, rows, points = ids[order], rows[order], points[order]
        self.pages = []
        step = max(1, len(points) * 2 // PAGE_ROWS)
        routers = points[np.unique(np.linspace(0, len(points) - 1, step).astype(int))]
        away = distances(points, routers, radius)
        nearest = away.argmin(1)
        for r in range(len(routers)):
            own = np.flatnonzero(nearest == r)
            own = own[np.argsort(away[own, r], kind="stable")]
            for start in range(0, len(own), PAGE_ROWS):
                at = own[start:start + PAGE_ROWS]
                self.pages.append((r, away[at, r], ids[at], rows[at], points[at]))
        self.routers = routers
        self.page_router = np.array([p[0] for p in self.pages])
        self.covering = np.array([p[1][-1] for p in self.pages])

    def search(self, queries: np.ndarray, own_rows: np.ndarray, bounds: np.ndarray, k: int) -> list[list[tuple[int, int, int]]]:
        """For each query its best (score, -id, row), best first; bounds: scores below them are of no use."""
        to_router = query_distances(queries, self.routers, self.radius)
        least = np.maximum(to_router[:, self.page_router] - self.covering[None], 0)
        norms = (queries * queries).sum(1) + self.radius
        return [self._search_one(q, int(own_rows[i]), float(norms[i]), to_router[i], least[i], float(bounds[i]), k) for i, q in enumerate(queries)]

    def _search_one(self, query, own_row, norm, to_router, least, bound, k):
        best: list[tuple[int, int, int]] = []
        limit = self._limit(norm, bound)
        for page in np.argsort(least, kind="stable"):
            if least[page] > limit:
                break
            router, away, ids, rows, points = self.pages[page]
            near = np.flatnonzero(np.abs(to_router[router] - away) <= limit)
            scores = points[near] @ query
            for j in np.flatnonzero(scores >= bound):
                at = near[j]
                if rows[at] != own_row:
                    entry = (int(scores[j]), -int(ids[at]), int(rows[at]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            if len(best) == k and best[0][0] > bound:
                bound = best[0][0]
                limit = self._limit(norm, bound)
        return sorted(best, reverse=True)

    @staticmethod
    def _limit(norm: float, bound: float) -> float:
        """The distance at which the product is ``bound``, and a slack for rounding."""
        if bound == -np.inf:
            return np.inf
        return float(np.sqrt(max(norm - 2 * bound, 0))) * (1 + 1e-9) + 1e-6


def top_k(vectors: DataFrame, k: int, is_query: Column) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` (vec_id, embedding) where ``is_query``, against all."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding")).alias("v"),
        is_query.alias("asks"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "vectors")
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    facts = rows.agg(F.max(norm).alias("norm"), F.max(F.size("v")).alias("width")).first()
    width, radius = max(1, facts["width"] or 1), float(facts["norm"] or 0)
    if radius * 2 >= 2.0 ** 53:
        raise ValueError("components are too large for exact products in double precision")
    sample = rows.select("v", "row").orderBy(F.xxhash64("row"), "row").limit(PIVOTS).collect()
    pivots = np.unique(_matrix([r["v"] for r in sample], width), axis=0) if sample else np.zeros((1, width))
    known = spark.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("v").to_pylist(), width)
            away = distances(points, known.value, radius)
            home = away.argmin(1) if len(points) else np.zeros(0, np.int64)
            yield batch.append_column("home", pa.array(home.astype(np.int32))).append_column(
                "away", pa.array(away[np.arange(len(points)), home]))

    placed = map_rows(rows, assign, "vec_id long, v array<long>, asks boolean, row long, home int, away double")
    placed = stored(placed, "placed-vectors")
    per = {r["home"]: (r["n"], r["r"], r["asks"]) for r in placed.groupBy("home").agg(
        F.count("*").alias("n"), F.max("away").alias("r"), F.sum(F.col("asks").cast("long")).alias("asks")).collect()}
    trees = {h: -(-n // TREE_ROWS) for h, (n, _, _) in per.items()}
    n_queries = sum(asks or 0 for _, _, asks in per.values())
    parts = max(1, -(-n_queries // QUERY_ROWS))  # blocks of queries, so that no task gets them all
    counts = F.create_map(*(F.lit(x) for h, n in trees.items() for x in (h, n))) if trees else F.create_map(F.lit(0), F.lit(1))
    kept = stored(placed.withColumn("tree", F.pmod(F.xxhash64("row"), F.element_at(counts, F.col("home")).cast("long")).cast("int")), "trees")
    queries = kept.filter("asks").select("vec_id", "row", "v", "home", "tree", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(parts)).cast("int").alias("part"))
    answer = "query_row long, query_id long, vec_id long, score long"

    def search(key: tuple, stored_rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(stored_rows) and len(asked):
            tree = Subtree(stored_rows["vec_id"].to_numpy(), stored_rows["row"].to_numpy(), _matrix(stored_rows["v"].to_list(), width), radius)
            found = tree.search(_matrix(asked["q_v"].to_list(), width), asked["q_row"].to_numpy(), asked["q_bound"].to_numpy(), k)
            for row, query_id, best in zip(asked["q_row"], asked["q_vec_id"], found, strict=True):
                out += [(row, query_id, -minus_id, score) for score, minus_id, _ in best]
        return pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "score"]).astype("int64")

    def searched(asked: DataFrame) -> DataFrame:
        """``asked``: (vec_id, row, v, home, tree, part, bound)."""
        copies = kept.select("vec_id", "row", "v", "home", "tree").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        asked = asked.select(*(F.col(c).alias(f"q_{c}") for c in ("vec_id", "row", "v", "bound", "home", "tree", "part")))
        return (copies.groupBy("home", "tree", "part").cogroup(asked.groupBy("q_home", "q_tree", "q_part"))
                .applyInPandas(search, answer))

    first = searched(queries.withColumn("bound", F.lit(float("-inf"))))
    best_first = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    bounds = first.groupBy("query_row").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    asked = queries.join(bounds.select(F.col("query_row").alias("row"), F.when(F.col("n") >= k, F.col("kth")).alias("kth")), "row", "left")
    asked = stored(asked.withColumn("bound", F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf")))).drop("kth", "home", "tree"), "query-bounds")
    balls = {h: r for h, (_, r, _) in per.items()}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        homes = np.array(sorted(balls), np.int64)
        reach = np.array([balls[h] for h in homes.tolist()])
        for batch in batches:
            points = _matrix(batch.column("v").to_pylist(), width)
            norms = (points * points).sum(1) + radius
            limits = np.array([Subtree._limit(n, b) for n, b in zip(norms, batch.column("bound").to_pylist(), strict=True)])
            least = query_distances(points, known.value[homes], radius) - reach[None]
            yield batch.append_column("homes", pa.array([homes[least[i] <= limits[i]].tolist() for i in range(len(points))], pa.list_(pa.int32())))

    routed = map_rows(asked.select("row", "vec_id", "v", "part", "bound"), route, "row long, vec_id long, v array<long>, part int, bound double, homes array<int>")
    to_trees = (routed.withColumn("home", F.explode("homes")).drop("homes")
                .withColumn("tree", F.explode(F.sequence(F.lit(0), F.element_at(counts, F.col("home")) - 1))))
    ranked = searched(to_trees).withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
