"""Stand-in flight and sensor tables derived from the driver's parquet tables.

The real inputs (airport / airline / route files, a sensor CSV) are not
available, so each is derived with Spark from a table of the same shape:

* ``all_airports`` ← ``part``: one airport per part; ``airports``, the vertex
  table of graphs, lacks those whose key ends in 3, so that routes reach
  "ghost" airports that have no attribute row, as real route files do.
* ``all_airlines`` ← ``supplier``; ``airlines``, the name table of carrier
  totals, lacks every seventh, so that the default-name rule fires.
* ``routes``    ← consecutive lines of one order, all lines: carrier =
  supplier, src = part, dest = next line's part.
* ``order_routes`` ← consecutive orders of one customer, all orders: carrier =
  customer, src = order, dest = next order; a graph of many components.
* ``sensor``    ← ``embeddings``: the first seven vector elements become the
  accelerometer / gyroscope / capacitance readings, the label the exercise.

All of them read whole tables; their size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import lead_in_group

POSITIONS = ("wrist", "pocket", "leg")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, country, latitude, longitude, without the ghosts."""
    return all_airports(spark, sf_dir).filter(F.col("id") % 10 != 3)


def all_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, country, latitude, longitude."""
    key = F.col("p_partkey")
    return (
        table(spark, sf_dir, "part")
        .select(
            key.alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("country"),
            ((key * 37) % 1600).cast("double") / 10.0 - 80.0,
            ((key * 101) % 3600).cast("double") / 10.0 - 180.0,
        )
        .toDF("id", "name", "country", "latitude", "longitude")
    )


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, without the carriers that have no name."""
    return all_airlines(spark, sf_dir).filter(F.col("id") % 7 != 0)


def all_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name."""
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))


def route_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines routes are made of (the 4-column projection reaches the scan)."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """airline_id, src_id, dest_id — one row per consecutive pair of lines.

    The line order inside an order is made total with the part and supplier
    keys because (orderkey, linenumber) is not unique in the data.  The pairing
    is a skew-safe lead (``operators.sequence``): an order with a huge number
    of lines is spread over many tasks.
    """
    lines = route_lines(spark, sf_dir)
    # lead over the order's lines, without sending a whole order to one task
    paired = lead_in_group(lines, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], "l_partkey", "dest_id")
    return paired.filter(F.col("dest_id").isNotNull()).select(
        F.col("l_suppkey").alias("airline_id"), F.col("l_partkey").alias("src_id"), "dest_id")


def order_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """airline_id, src_id, dest_id — one row per consecutive pair of a customer's orders."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    paired = lead_in_group(orders, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey", "dest_id")
    return paired.filter(F.col("dest_id").isNotNull()).select(
        F.col("o_custkey").alias("airline_id"), F.col("o_orderkey").alias("src_id"), "dest_id")


def airport_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport rows as raw text, the way a delimited file presents them.

    Small airports carry the missing-value sentinel as IATA code, the largest
    ones have an empty ICAO field, and expensive parts an unparsable altitude
    — exercising the reject-missing and typed-cast steps.
    """
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("city"),
        F.col("p_brand").alias("country"),
        F.when(F.col("p_size") < 10, F.lit("\\N")).otherwise(F.upper(F.substring("p_name", 1, 3))).alias("iata"),
        F.when(F.col("p_size") > 45, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("K"), key.cast("string"))).alias("icao"),
        F.when(F.col("p_retailprice") >= 1900, F.lit("n/a"))
        .otherwise((F.col("p_size") * 100).cast("string")).alias("altitude"),
        ((F.col("p_size") % 25) - 12).cast("string").alias("timezone_offset"),
    )


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, Subject, Position, Session, A_x .. C_1 (double), Workout."""
    emb = F.col("embedding")
    vid = F.col("vec_id")
    position = F.when(vid % 3 == 0, POSITIONS[0]).when(vid % 3 == 1, POSITIONS[1]).otherwise(POSITIONS[2])
    readings = ["A_x", "A_y", "A_z", "G_x", "G_y", "G_z", "C_1"]
    return table(spark, sf_dir, "embeddings").select(
        vid.alias("id"),
        (vid % 10).cast("int").alias("Subject"),
        position.alias("Position"),
        (vid % 5).cast("int").alias("Session"),
        *[emb.getItem(i).cast("double").alias(name) for i, name in enumerate(readings)],
        F.concat(F.lit("w"), F.col("label").cast("string")).alias("Workout"),
    )
