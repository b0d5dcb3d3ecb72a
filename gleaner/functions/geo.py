"""Geo expressions over latitude / longitude columns in degrees."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = EARTH_RADIUS_KM * math.pi / 180


def distance_km(lat: Column, lon: Column, at_lat: float, at_lon: float) -> Column:
    """Great-circle distance by the haversine formula."""
    half_lat = F.radians(lat - F.lit(float(at_lat))) / 2
    half_lon = F.radians(lon - F.lit(float(at_lon))) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat)) * F.lit(
        math.cos(math.radians(at_lat))
    ) * F.pow(F.sin(half_lon), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def within_km(lat: Column, lon: Column, at_lat: float, at_lon: float, km: float) -> Column:
    """Circle filter; a plain latitude band comes first and reaches the scan."""
    reach = km / KM_PER_DEGREE + 1e-6
    band = lat.between(float(at_lat - reach), float(at_lat + reach))
    return band & (distance_km(lat, lon, at_lat, at_lon) <= km)


def in_polygon(lat: Column, lon: Column, corners: list[tuple[float, float]]) -> Column:
    """Even-odd rule over the edges of a closed polygon of (lat, lon) corners."""
    crossings = []
    for (lat_a, lon_a), (lat_b, lon_b) in zip(corners, corners[-1:] + corners[:-1]):
        if lat_a == lat_b:
            continue  # an edge along a parallel never crosses the ray
        straddles = (F.lit(float(lat_a)) > lat) != (F.lit(float(lat_b)) > lat)
        slope = (lon_b - lon_a) / (lat_b - lat_a)
        crossings.append((straddles & (lon < (lat - lat_a) * slope + lon_a)).cast("int"))
    lats = [c[0] for c in corners]
    lons = [c[1] for c in corners]
    box = lat.between(float(min(lats)), float(max(lats))) & lon.between(float(min(lons)), float(max(lons)))
    return box & (reduce(lambda a, b: a + b, crossings) % 2 == 1)


def snap(degrees: Column, digits: int) -> Column:
    """Coordinates at a coarser precision: rounded half up to ``digits`` decimals."""
    scale = float(10**digits)
    return F.floor(degrees * scale + 0.5) / scale
