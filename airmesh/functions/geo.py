"""Great-circle distance as a single Column expression (no UDF, stays in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed value: mean Earth radius in km used for every distance ---
EARTH_RADIUS_KM = 6371.0088
# --- end fixed value ---


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance in km between two (lat, lon) points given in degrees.

    ``sqrt(a)`` is clamped to 1 before ``asin`` so antipodal rounding error
    can't produce NaN; NaN inputs still yield NaN (callers filter it).
    """
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), 2)
    return F.lit(radius_km) * (F.lit(2.0) * F.asin(F.least(F.lit(1.0), F.sqrt(a))))


def valid_distance(km) -> Column:
    """True for a usable edge length: not NaN and strictly positive.

    Spark orders NaN above every number, so ``km > 0`` alone would keep NaN.
    """
    km = _c(km)
    return ~F.isnan(km) & (km > F.lit(0.0))
