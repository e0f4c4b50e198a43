"""Column expressions used by the operators."""

from .geo import EARTH_RADIUS_KM, haversine_km, valid_distance
from .paths import path_text

__all__ = ["EARTH_RADIUS_KM", "haversine_km", "valid_distance", "path_text"]
