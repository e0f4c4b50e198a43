"""Delimited-text and parquet readers with declared schemas and value cleaning.

Pipeline for every typed reader (all steps are Catalyst expressions, so the
null / sentinel predicates reach the scan and only the chosen ordinals are
parsed):

1. bind the chosen ordinals to names (positional projection),
2. drop a row when any *selected* column is null or equals the missing-value
   sentinel — unselected columns never matter,
3. cast each column to its declared type with ``try_cast`` so malformed
   numbers become null instead of failing the job under ANSI mode,
4. project in the caller's order.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import (
    AIRLINE_FIELDS,
    AIRPORT_FIELDS,
    MISSING_SENTINEL,
    ROUTE_FIELDS,
    SENSOR_COLUMNS,
    Field,
)

# --- fixed values: CSV parsing options of the header-less flight files ---
CSV_OPTIONS = {
    "header": "false",
    "inferSchema": "false",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "multiLine": "false",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
# --- end fixed values ---


def _conjunction(preds: list[Column]) -> Column:
    return functools.reduce(operator.and_, preds) if preds else F.lit(True)


def text_schema(width: int) -> T.StructType:
    """All-string schema ``_c0 .. _c{width-1}`` as the CSV reader names columns.

    Declaring it up front (instead of letting the first line decide the width)
    keeps short rows padded with nulls and lets the CSV scan prune columns.
    """
    return T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(width)])


def reject_missing(df: DataFrame, columns: list[str] | tuple[str, ...], sentinel: str | None = MISSING_SENTINEL) -> DataFrame:
    """Drop rows where any of ``columns`` is null or equals ``sentinel``.

    The sentinel test only applies to string columns; typed columns can't hold it.
    """
    types = dict(df.dtypes)
    preds = [F.col(c).isNotNull() for c in columns]
    if sentinel is not None:
        preds += [F.col(c) != F.lit(sentinel) for c in columns if types[c] == "string"]
    return df.filter(_conjunction(preds))


def typed_cast(df: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """Cast each field to its declared type; malformed values become null."""
    return df.select(*[F.col(f.name).try_cast(f.dtype).alias(f.name) for f in fields])


def bind_fields(raw: DataFrame, fields: tuple[Field, ...], sentinel: str | None = MISSING_SENTINEL) -> DataFrame:
    """Positional projection + missing rejection + typed cast over ``_cN`` columns."""
    named = raw.select(*[F.col(f.source_column).alias(f.name) for f in fields])
    return typed_cast(reject_missing(named, [f.name for f in fields], sentinel), fields)


def clean_named(df: DataFrame, fields: tuple[Field, ...], sentinel: str | None = MISSING_SENTINEL) -> DataFrame:
    """Same cleaning for a frame whose columns already carry the field names (parquet twins)."""
    return typed_cast(reject_missing(df.select(*[f.name for f in fields]), [f.name for f in fields], sentinel), fields)


def read_delimited(spark: SparkSession, path: str, fields: tuple[Field, ...], width: int | None = None,
                   sentinel: str | None = MISSING_SENTINEL) -> DataFrame:
    """Header-less delimited scan bound to ``fields`` by ordinal."""
    width = width or (max(f.ordinal for f in fields) + 1)
    raw = spark.read.options(**CSV_OPTIONS).schema(text_schema(width)).csv(path)
    return bind_fields(raw, fields, sentinel)


def reject_reason(fields: tuple[Field, ...], sentinel: str | None = MISSING_SENTINEL) -> Column:
    """Why a row of text columns named as ``fields`` can't be taken: the first field that is missing or malformed; else null."""
    checks = []
    for f in fields:
        missing = F.col(f.name).isNull() if sentinel is None else F.col(f.name).isNull() | (F.col(f.name) == sentinel)
        checks.append(F.when(missing, F.lit(f"missing {f.name}")).when(F.col(f.name).try_cast(f.dtype).isNull(), F.lit(f"malformed {f.name}")))
    return F.coalesce(*checks)


def read_quarantined(spark: SparkSession, path: str, fields: tuple[Field, ...], width: int,
                     sentinel: str | None = MISSING_SENTINEL) -> tuple[DataFrame, DataFrame]:
    """Rows of a header-less delimited file that fit ``fields``, typed, and all others as text with their ``reason``.

    Every line is in one of the two: nothing is lost or becomes null unseen.
    Lines with another number of fields than ``width`` are rejected whole.
    """
    schema = text_schema(width).add("_line", T.StringType())
    raw = spark.read.options(**CSV_OPTIONS, columnNameOfCorruptRecord="_line").schema(schema).csv(path)
    named = raw.select(*[F.col(f.source_column).alias(f.name) for f in fields], "_line")
    judged = named.withColumn("reason", F.when(F.col("_line").isNotNull(), F.lit("number of fields")).otherwise(reject_reason(fields, sentinel)))
    return typed_cast(judged.filter(F.col("reason").isNull()), fields), judged.filter(F.col("reason").isNotNull()).drop("_line")


def write_delimited(df: DataFrame, path: str, header: bool = False) -> None:
    """Write rows the way the readers expect them: quoted by need, quotes doubled, null as an empty field."""
    df.write.mode("overwrite").options(header=str(header).lower(), quote='"', escape='"', nullValue="").csv(path)


def read_airports(spark: SparkSession, path: str, fields: tuple[Field, ...] = AIRPORT_FIELDS) -> DataFrame:
    return read_delimited(spark, path, fields, width=len(AIRPORT_FIELDS))


def read_airlines(spark: SparkSession, path: str, fields: tuple[Field, ...] = AIRLINE_FIELDS) -> DataFrame:
    return read_delimited(spark, path, fields, width=len(AIRLINE_FIELDS))


def read_routes(spark: SparkSession, path: str, fields: tuple[Field, ...] = ROUTE_FIELDS) -> DataFrame:
    return read_delimited(spark, path, fields, width=len(ROUTE_FIELDS))


def read_headered(spark: SparkSession, path: str,
                  columns: tuple[tuple[str, T.DataType], ...] = SENSOR_COLUMNS) -> DataFrame:
    """Headered CSV read as strings, then named columns cast to declared types."""
    raw = spark.read.options(header="true", inferSchema="false").csv(path)
    return raw.select(*[F.col(name).try_cast(dtype).alias(name) for name, dtype in columns])
