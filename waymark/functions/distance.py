"""Distances between two points given in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius and length of one degree, in km.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111


def square(value: Column) -> Column:
    return value * value


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km; antipodal points give half the circumference, never NaN."""
    across = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    half_chord_sq = (
        square(F.sin(F.radians(lat2 - lat1) / 2))
        + across * square(F.sin(F.radians(lon2 - lon1) / 2))
    )
    # Rounding can push the term past 1 near the antipode, where sqrt(1 - x) is undefined.
    half_chord_sq = F.least(F.lit(1.0), half_chord_sq)
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(half_chord_sq), F.sqrt(1 - half_chord_sq))


def planar_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Flat distance in km with every degree 111 km long.

    Longitude degrees are not shortened with latitude, so east-west distances are overstated.
    """
    return F.sqrt(square(lat1 - lat2) + square(lon1 - lon2)) * KM_PER_DEGREE


def unit_sphere(lat: Column, lon: Column) -> list[Column]:
    """A point on the sphere of radius one, in space."""
    lat, lon = F.radians(lat), F.radians(lon)
    return [F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)]


METRICS = {"haversine": haversine_km, "planar": planar_km}


def metric_function(metric: str):
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {sorted(METRICS)}")
    return METRICS[metric]
