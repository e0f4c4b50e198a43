"""Skew-safe join of a large edge table with per-vertex values.

Graph algorithms repeatedly join ``edges`` (big) with a per-vertex table
(``ranks``, ``labels``, ``minimum neighbour``) on a vertex key.  A hub vertex
that owns a third of all edges would put a third of the edge table into one
shuffle partition.  Instead keys are split:

* *hot* keys — more than ``threshold`` edges — are few by construction
  (at most ``n_edges / threshold`` of them), so their vertex values form a
  table of bounded size that is broadcast; their edges are joined map-side
  where they already sit, never shuffled by key;
* every other key goes through a regular shuffle join, which now has no
  partition larger than ``threshold`` rows per key.

The threshold is derived from the edge count and the shuffle parallelism, so
the hot set stays small at any scale; its size is checked before broadcasting.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bucketed_table, cut_lineage

MIN_HOT_DEGREE = 100_000
HOT_KEYS_PER_PARTITION = 4
MAX_BROADCAST_HOT_KEYS = 1_000_000


@dataclass(frozen=True)
class HotKeys:
    ids: DataFrame | None  # column ``id``; None when no key is hot
    count: int
    threshold: int


NOTHING_HOT = HotKeys(None, 0, 0)


def hot_threshold(n_edges: int, partitions: int) -> int:
    """Degree above which a key is split out: at least MIN_HOT_DEGREE."""
    return max(MIN_HOT_DEGREE, n_edges // max(1, partitions * HOT_KEYS_PER_PARTITION))


def find_hot_keys(degrees: DataFrame, n_edges: int, key: str = "id", degree: str = "degree") -> HotKeys:
    """Keys whose degree exceeds the threshold; their number is bounded by n_edges / threshold."""
    spark = degrees.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    threshold = hot_threshold(n_edges, partitions)
    if n_edges <= threshold:  # no key can exceed the threshold: skip the scan
        return HotKeys(None, 0, threshold)
    hot = degrees.filter(F.col(degree) > threshold).select(F.col(key).alias("id"))
    count = hot.count()
    if count == 0:
        return HotKeys(None, 0, threshold)
    if count > MAX_BROADCAST_HOT_KEYS:  # cannot happen: count <= n_edges / threshold
        raise RuntimeError(f"{count} hot keys exceed the broadcast bound")
    return HotKeys(hot, count, threshold)


def join_vertex_values(edges: DataFrame, edge_key: str, values: DataFrame, hot: HotKeys,
                       how: str = "inner", broadcast_values: bool = False) -> DataFrame:
    """``edges ⋈ values`` on ``edges[edge_key] = values.id``, splitting hot keys.

    ``values`` has column ``id`` plus value columns (one row per id).  With
    ``broadcast_values`` (caller checked the size with ``fits_broadcast``) the
    whole value table is broadcast: edges stay where they are and skew is moot.
    """
    vals = values.withColumnRenamed("id", edge_key)
    if broadcast_values:
        return edges.join(F.broadcast(vals), edge_key, how)
    if hot.ids is None:
        return edges.join(vals, edge_key, how)
    hot_ids = F.broadcast(hot.ids.withColumnRenamed("id", edge_key))
    hot_vals = F.broadcast(vals.join(hot_ids, edge_key, "left_semi"))
    hot_part = edges.join(hot_ids, edge_key, "left_semi").join(hot_vals, edge_key, how)
    cold_part = edges.join(hot_ids, edge_key, "left_anti").join(vals, edge_key, how)
    return hot_part.unionByName(cold_part)


@dataclass(frozen=True)
class SenderEdges:
    """Edges laid out for a join with per-vertex values, round after round.

    ``cold`` is bucketed on the sender; the edges of hot senders (at most
    ``HOT_KEYS_PER_PARTITION`` per partition of them) are ``hot_edges``, left in
    even parts and joined with the broadcast values of those few senders.
    """

    cold: DataFrame
    hot_edges: DataFrame | None
    hot: HotKeys
    key: str

    def with_values(self, values: DataFrame) -> DataFrame:
        """Edges and the value columns of ``values`` (``id``, ...)."""
        vals = values.withColumnRenamed("id", self.key)
        out = self.cold.join(vals, self.key)
        if self.hot_edges is None:
            return out
        few = vals.join(F.broadcast(self.hot.ids.withColumnRenamed("id", self.key)), self.key, "left_semi")
        return out.unionByName(self.hot_edges.join(F.broadcast(few), self.key))


def bucket_senders(edges: DataFrame, key: str, buckets: int, name: str) -> SenderEdges:
    """Write ``edges`` once: bucketed on ``key``, but for those of hot keys."""
    edges = cut_lineage(edges)
    degrees = edges.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    hot = find_hot_keys(degrees, edges.count())
    if hot.ids is None:
        return SenderEdges(bucketed_table(edges, key, buckets, name), None, hot, key)
    hot = HotKeys(cut_lineage(hot.ids), hot.count, hot.threshold)
    ids = F.broadcast(hot.ids.withColumnRenamed("id", key))
    even = cut_lineage(edges.join(ids, key, "left_semi").repartition(buckets))
    return SenderEdges(bucketed_table(edges.join(ids, key, "left_anti"), key, buckets, name), even, hot, key)


STATE_BYTES_PER_ROW = 64  # id + a few numeric columns, with row overhead


def _size_in_bytes(text: str) -> int:
    t = text.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if t.endswith(suffix):
            return int(float(t[: -len(suffix)]) * units[suffix])
    return int(t)


def fits_broadcast(spark, n_rows: int, bytes_per_row: int = STATE_BYTES_PER_ROW) -> bool:
    """True when a per-vertex table of ``n_rows`` is under the session's broadcast threshold."""
    limit = _size_in_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))
    return limit > 0 and n_rows * bytes_per_row <= limit
