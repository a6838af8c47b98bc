"""Distances."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in kilometres between two points in degrees."""

    def squared_half_sine(a: Column, b: Column) -> Column:
        half = F.sin((F.radians(b) - F.radians(a)) / 2)
        return half * half

    chord = squared_half_sine(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * squared_half_sine(
        lon1, lon2
    )
    return F.lit(2 * radius) * F.asin(F.sqrt(chord))


def whole_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.round(haversine(lat1, lon1, lat2, lon2)).try_cast("smallint")
