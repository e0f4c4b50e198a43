"""Declared table layouts: (ordinal, name, type) per column.

Header-less delimited files are bound to names and types by position, never
by inference.  Callers pick the subset of fields they need; the reader only
touches those ordinals so the scan prunes the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    ordinal: int
    name: str
    dtype: T.DataType

    @property
    def source_column(self) -> str:
        """Column name Spark's CSV reader assigns to this ordinal."""
        return f"_c{self.ordinal}"


_L, _S, _D, _I = T.LongType(), T.StringType(), T.DoubleType(), T.IntegerType()

# --- fixed values: column layouts of the airport / airline / route files and the sensor table ---
AIRPORT_FIELDS = (
    Field(0, "id", _L),
    Field(1, "name", _S),
    Field(2, "city", _S),
    Field(3, "country", _S),
    Field(4, "iata", _S),
    Field(5, "icao", _S),
    Field(6, "latitude", _D),
    Field(7, "longitude", _D),
    Field(8, "altitude", _D),
    Field(9, "timezone_offset", _I),
    Field(10, "daylight_saving_time", _S),
)
AIRLINE_FIELDS = (
    Field(0, "id", _L),
    Field(1, "name", _S),
    Field(2, "alias", _S),
    Field(3, "iata", _S),
    Field(4, "icao", _S),
    Field(5, "callsign", _S),
    Field(6, "country", _S),
    Field(7, "active", _S),
)
ROUTE_FIELDS = (
    Field(0, "airline", _S),
    Field(1, "airline_id", _L),
    Field(2, "src", _S),
    Field(3, "src_id", _L),
    Field(4, "dest", _S),
    Field(5, "dest_id", _L),
    Field(6, "codeshare", _S),
    Field(7, "stops", _I),
    Field(8, "equipment", _S),
)
SENSOR_COLUMNS = (
    ("Subject", _I),
    ("Position", _S),
    ("Session", _I),
    ("A_x", _D),
    ("A_y", _D),
    ("A_z", _D),
    ("G_x", _D),
    ("G_y", _D),
    ("G_z", _D),
    ("C_1", _D),
    ("Workout", _S),
)
SENSOR_NUMERIC = ("A_x", "A_y", "A_z", "G_x", "G_y", "G_z", "C_1")
SENSOR_GYRO = ("G_x", "G_y", "G_z")
MISSING_SENTINEL = "\\N"
# --- end fixed values ---


def pick(fields: tuple[Field, ...], *names: str) -> tuple[Field, ...]:
    """Select fields by name, keeping the caller's order."""
    by_name = {f.name: f for f in fields}
    missing = [n for n in names if n not in by_name]
    if missing:
        raise KeyError(f"unknown fields {missing}; have {sorted(by_name)}")
    return tuple(by_name[n] for n in names)
