"""Distances on the sphere, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0

# Rounding room, in metres, between a straight-line distance computed from
# x/y/z and the arc computed from latitude and longitude.
SLACK_M = 1e-6


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; null if any input is null."""
    lat1, lon1, lat2, lon2 = map(F.radians, (lat1, lon1, lat2, lon2))
    half_lat = F.sin((lat2 - lat1) / 2)
    half_lon = F.sin((lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * (half_lon * half_lon)
    return F.lit(EARTH_RADIUS_M) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


def xyz(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Earth-centred coordinates in metres: no seam at the poles or at 180 degrees."""
    phi, lam = F.radians(lat), F.radians(lon)
    r = F.lit(EARTH_RADIUS_M)
    return r * F.cos(phi) * F.cos(lam), r * F.cos(phi) * F.sin(lam), r * F.sin(phi)


def chord(arc: Column) -> Column:
    """Straight-line length of an arc; two points are within `arc` iff within this."""
    capped = F.least(arc, F.lit(math.pi * EARTH_RADIUS_M))
    return F.lit(2 * EARTH_RADIUS_M) * F.sin(capped / (2 * EARTH_RADIUS_M))
