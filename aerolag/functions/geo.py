"""Distances on a sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def central_angle(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine angle between two points given in degrees, in radians."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * 2


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return central_angle(lat1, lon1, lat2, lon2) * F.lit(EARTH_RADIUS_KM)
