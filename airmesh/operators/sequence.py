"""Skew-safe "next row in group" (``lead`` over an ordered group).

``lead(v) OVER (PARTITION BY g ORDER BY k...)`` sends every row of a group to
one task, so a group holding a third of the table becomes one straggler task.
This operator produces the same rows without that bound:

1. range-partition the rows on ``(g, k...)`` and sort within partitions — a hot
   group is cut into many partitions by its order keys;
2. the partition id is pinned by writing the rows as a table
   (range bounds are sampled, so they must not be recomputed differently);
3. ``lead`` inside each (partition, group) slice — a slice is never larger
   than one partition;
4. the last row of a slice takes the first row of the next non-empty
   partition when that partition starts with the same group.  The table of
   first rows has one row per partition (a proven bound), so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, materialize


def _range_sorted(df: DataFrame, keys: list, partitions: int | None) -> DataFrame:
    """Range-partition on ``keys`` and sort inside partitions.

    Without an explicit count the exchange uses the session's shuffle
    partitions and AQE may merge *adjacent* ranges for small inputs, which keeps
    the global order that the partition ids encode.
    """
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def lead_in_group(df: DataFrame, group: str, order: list[str], value: str, out: str,
                  partitions: int | None = None) -> DataFrame:
    """``df`` plus column ``out`` = ``value`` of the next row of the same group
    in ``order`` (null for the group's last row); rows tied on every order key
    are interchangeable, as with a window ``lead``."""
    keys = [group, *order]
    ranged = materialize(_range_sorted(df, keys, partitions).withColumn("_pid", F.spark_partition_id()), "lead")
    slice_order = Window.partitionBy("_pid", group).orderBy(*order)
    # a null lead may be a null value: the last row of a slice is told by a lead of a constant
    local = ranged.withColumn(out, F.lead(value).over(slice_order)).withColumn(
        "_last", F.lead(F.lit(True)).over(slice_order).isNull())
    firsts = ranged.groupBy("_pid").agg(F.min(F.struct(*[F.col(c) for c in keys], F.col(value).alias("_v"))).alias("f"))
    stitch = firsts.select(
        F.lag("_pid").over(Window.orderBy("_pid")).alias("_prev_pid"),  # one row per partition
        F.col(f"f.{group}").alias("_g"), F.col("f._v").alias("_next_v"),
    ).filter(F.col("_prev_pid").isNotNull())
    joined = local.join(
        F.broadcast(stitch),
        (local["_pid"] == stitch["_prev_pid"]) & local[group].eqNullSafe(stitch["_g"]) & local["_last"],
        "left",
    )
    return joined.select(*df.columns, F.when(F.col("_last"), F.col("_next_v")).otherwise(F.col(out)).alias(out))


def global_rank(df: DataFrame, order: list, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = 1-based position in the total order ``order`` (row_number
    semantics) without a single-partition window.

    Rows are range-partitioned on the order (pinned in the checkpoint folder),
    numbered inside their partition, and shifted by the row counts of the
    partitions before them — a table with one row per partition.
    """
    ranged = cut_lineage(_range_sorted(df, order, partitions).withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(  # one row per partition
        "_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)).alias("_off"))
    return local.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_off") + F.col("_local")).cast("long").alias(out))
