"""Geo points as ``struct<lat:double,lon:double>``: parsing, hashing, distance."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Geohash alphabet, earth radius, unit names.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
EARTH_RADIUS_M = 6371008.8
UNITS_M = {"m": 1.0, "km": 1000.0, "mi": 1609.344, "yd": 0.9144, "ft": 0.3048,
           "nm": 1852.0, "cm": 0.01, "mm": 0.001}


def point(lat: Column, lon: Column) -> Column:
    return F.struct(lat.cast("double").alias("lat"), lon.cast("double").alias("lon"))


def _checked(lat: Column, lon: Column) -> Column:
    return F.when(lat.between(-90, 90) & lon.between(-180, 180), point(lat, lon))


def point_from_text(text: Column) -> Column:
    """``"lat,lon"``; null when malformed or out of range."""
    parts = F.split(text, ",")
    lat, lon = (F.trim(F.get(parts, F.lit(i))).try_cast("double") for i in (0, 1))
    return F.when(F.size(parts) == 2, _checked(lat, lon))


def point_from_array(lon_lat: Column) -> Column:
    """``[lon, lat]`` in the GeoJSON order."""
    return F.when(F.size(lon_lat) == 2,
                  _checked(F.get(lon_lat, F.lit(1)), F.get(lon_lat, F.lit(0))))


def point_from_struct(value: Column) -> Column:
    return _checked(value["lat"], value["lon"])


def lat_lon(p: Column) -> tuple[Column, Column]:
    return p["lat"], p["lon"]


def geohash(p: Column, precision: int = 12) -> Column:
    """Geohash text: lon and lat cells as whole numbers, bits interleaved 5 by 5."""
    bits = precision * 5
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2

    def cell(value: Column, low: float, width: float, n: int) -> Column:
        scaled = F.floor((value - low) / width * F.lit(float(2**n))).cast("long")
        return F.least(scaled, F.lit(2**n - 1).cast("long"))

    lon, lat = cell(p["lon"], -180.0, 360.0, lon_bits), cell(p["lat"], -90.0, 180.0, lat_bits)

    def bit(i: int) -> Column:
        source, shift = (lon, lon_bits - 1 - i // 2) if i % 2 == 0 else (lat, lat_bits - 1 - i // 2)
        return F.shiftright(source, shift).bitwiseAND(F.lit(1)).cast("int")

    chars = []
    for c in range(precision):
        digit = sum((bit(c * 5 + k) * (16 >> k) for k in range(1, 5)), bit(c * 5) * 16)
        chars.append(F.substring(F.lit(GEOHASH_ALPHABET), digit + 1, F.lit(1)))
    return F.concat(*chars)


def metres(distance: str | float) -> float:
    """``"50km"`` → 50000.0; a bare number is kilometres."""
    if isinstance(distance, (int, float)):
        return distance * UNITS_M["km"]
    found = re.fullmatch(r"\s*([0-9.]+)\s*([a-z]*)\s*", distance.lower())
    if not found or (found[2] or "km") not in UNITS_M:
        raise ValueError(f"bad distance {distance!r}")
    return float(found[1]) * UNITS_M[found[2] or "km"]


def haversine(p: Column, lat: float, lon: float) -> Column:
    """Great-circle distance in metres to a fixed location."""
    lat1, lat2 = F.radians(p["lat"]), F.lit(math.radians(lat))
    half_lat = F.sin((lat1 - lat2) / 2)
    half_lon = F.sin((F.radians(p["lon"]) - F.lit(math.radians(lon))) / 2)
    a = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def within_latitudes(p: Column, lat: float, limit_m: float) -> Column:
    """Cheap pre-filter: latitude band that contains the whole circle."""
    degrees = math.degrees(limit_m / EARTH_RADIUS_M) + 1e-9
    return p["lat"].between(lat - degrees, lat + degrees)


def in_polygon(p: Column, points: list[tuple[float, float]]) -> Column:
    """Even-odd ray casting against ``(lat, lon)`` vertices."""
    if len(points) < 3:
        raise ValueError("a polygon needs at least 3 points")
    crossings = []
    for (lat1, lon1), (lat2, lon2) in zip(points, points[1:] + points[:1]):
        if lat1 == lat2:
            continue
        straddles = (p["lat"] < lat1) != (p["lat"] < lat2)
        at_lon = F.lit(lon1) + (p["lat"] - lat1) * ((lon2 - lon1) / (lat2 - lat1))
        crossings.append((straddles & (p["lon"] < at_lon)).cast("int"))
    return sum(crossings[1:], crossings[0]) % 2 == 1
