"""Great-circle distance as a column expression (FN-5, JOIN-8)."""

from __future__ import annotations

import math

# Fixed value: mean Earth radius in km used by the source system.
EARTH_RADIUS_KM = 6371.0


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance in km between two points in degrees, as a SQL expression."""
    return (f"{EARTH_RADIUS_KM}D * 2 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))")


def km_per_degree_lat() -> float:
    return math.pi * EARTH_RADIUS_KM / 180.0
