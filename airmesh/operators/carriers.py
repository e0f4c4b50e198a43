"""Carrier distance totals and the longest / shortest flying carriers.

Plan: scan routes + airports → two equi-joins for coordinates → haversine
projection → filter → partial/final hash aggregate by carrier → two
TakeOrderedAndProject (top-1 each) → left join for the carrier name.
Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import weighted_edges

DEFAULT_NAME_PREFIX = "Airline#"


def airline_totals(routes: DataFrame, airports: DataFrame, digits: int | None = 4) -> DataFrame:
    """``airline_id, total_km, n_routes`` over all (non-distinct) route rows.

    Duplicate route rows count each time.  Map-side partial aggregation keeps
    a carrier flying a third of all routes to one partial row per task.
    """
    edges = weighted_edges(routes, airports, keep=("airline_id",))
    total = F.sum("km") if digits is None else F.round(F.sum("km"), digits)
    return edges.groupBy("airline_id").agg(
        total.alias("total_km"),
        F.count(F.lit(1)).alias("n_routes"),
    )


def with_carrier_name(df: DataFrame, airlines: DataFrame, key: str = "airline_id") -> DataFrame:
    """Left lookup of the carrier name, ``Airline#<id>`` when unknown."""
    names = airlines.groupBy(F.col("id").alias(key)).agg(F.min("name").alias("_name"))
    fallback = F.concat(F.lit(DEFAULT_NAME_PREFIX), F.col(key).cast("string"))
    return df.join(names, key, "left").withColumn("name", F.coalesce(F.col("_name"), fallback)).drop("_name")


def airline_extremes(routes: DataFrame, airports: DataFrame, airlines: DataFrame, digits: int = 2) -> DataFrame:
    """Two rows: ``kind`` = 'max' / 'min' total distance, with carrier name.

    Ties break on the smaller carrier id, so the answer is deterministic.
    """
    totals = airline_totals(routes, airports, digits=None)
    top = totals.orderBy(F.desc("total_km"), F.asc("airline_id")).limit(1).withColumn("kind", F.lit("max"))
    bottom = totals.orderBy(F.asc("total_km"), F.asc("airline_id")).limit(1).withColumn("kind", F.lit("min"))
    both = top.unionByName(bottom)
    return with_carrier_name(both, airlines).select(
        "kind", "airline_id", "name", F.round("total_km", digits).alias("total_km"), "n_routes"
    )
