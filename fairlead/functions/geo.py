"""Distances, times and speeds as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
KM_PER_NM = 1.852


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null if a coordinate is."""
    north, south = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = (south - north) / 2, (F.radians(lon2) - F.radians(lon1)) / 2
    a = F.sin(half_lat) * F.sin(half_lat) + F.cos(north) * F.cos(south) * F.sin(half_lon) * F.sin(half_lon)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def haversine_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return haversine_km(lat1, lon1, lat2, lon2) / KM_PER_NM


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with their fraction. A difference of two times without zone, so the session's zone has no part in it."""
    return (end - start).cast("interval second").cast("decimal(18,6)").cast("double")


def whole_seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds, truncated toward zero."""
    return (end - start).cast("interval second").cast("decimal(18,6)").cast("long")


def velocity_knots(lat1: Column, lon1: Column, t1: Column, lat2: Column, lon2: Column, t2: Column) -> Column:
    """Speed between two positions: infinite if a coordinate is null or no time has passed; null if a time is."""
    hours = seconds_between(t1, t2) / 3600
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    endless = F.lit(float("inf"))
    return F.when(t1.isNull() | t2.isNull(), None).when(~known | (hours <= 0), endless).otherwise(haversine_nm(lat1, lon1, lat2, lon2) / hours)


def nearest_cluster(lat: Column, lon: Column, a_lat: Column, a_lon: Column, b_lat: Column, b_lon: Column) -> Column:
    """``A`` or ``B``, whichever centroid is nearer; ``A`` if both are as near or the position is null."""
    to_a, to_b = haversine_km(lat, lon, a_lat, a_lon), haversine_km(lat, lon, b_lat, b_lon)
    return F.when(F.coalesce(to_b < to_a, F.lit(False)), "B").otherwise("A")
