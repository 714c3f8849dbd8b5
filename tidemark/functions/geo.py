"""Points as latitude and longitude columns; distances on a sphere."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

EARTH_RADIUS_M = 6371010.0
METRES_PER_MILE = 1609.34
_POINT = r"POINT\s*\(\s*(-?[0-9.]+)\s+(-?[0-9.]+)\s*\)"


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres (haversine)."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def distance_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return distance_m(lat1, lon1, lat2, lon2) / METRES_PER_MILE


def within_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, metres: float) -> Column:
    return distance_m(lat1, lon1, lat2, lon2) <= F.lit(metres)


def point_lon(wkt: Column) -> Column:
    return F.regexp_extract(wkt, _POINT, 1).cast("double")


def point_lat(wkt: Column) -> Column:
    return F.regexp_extract(wkt, _POINT, 2).cast("double")


def vertex_mean(points: list[tuple[Column, Column]]) -> tuple[Column, Column]:
    """Mean of vertices, the centroid of a small polygon."""
    lat = reduce(lambda a, b: a + b, (p[0] for p in points)) / len(points)
    lon = reduce(lambda a, b: a + b, (p[1] for p in points)) / len(points)
    return lat, lon
