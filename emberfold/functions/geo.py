"""Spherical and Web Mercator geometry as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
MERCATOR_RADIUS = 6378137.0


def hav(delta_rad: Column) -> Column:
    """Haversine of an angle, sin^2(x/2)."""
    half = F.sin(delta_rad / F.lit(2.0))
    return half * half


def hav_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine of the central angle between two points in degrees.

    It grows with distance, so radius tests compare it with ``hav_of_km`` and skip the asin.
    """
    p1, p2 = F.radians(lat1), F.radians(lat2)
    return hav(p2 - p1) + F.cos(p1) * F.cos(p2) * hav(F.radians(lon2) - F.radians(lon1))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = hav_distance(lat1, lon1, lat2, lon2)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def mercator_x(lon: Column) -> Column:
    return F.lit(MERCATOR_RADIUS) * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    return F.lit(MERCATOR_RADIUS) * F.log(F.tan(F.lit(0.7853981633974483) + F.radians(lat) / 2.0))


def round_half_even(value: Column, places: int = 2) -> Column:
    """Scale, round half to even, unscale: what array libraries do, unlike SQL ``round``."""
    scale = F.lit(float(10**places))
    return F.rint(value * scale) / scale


def exact_mean(total: Column, count: Column) -> Column:
    """Mean from ``nano_sum``; the same for any order of the rows, unlike a sum of doubles."""
    return F.try_divide(total.cast("double"), count) / 1e9


def nano_sum(value: Column) -> Column:
    """Exact sum in units of 1e-9, as an aggregate."""
    return F.sum(F.rint(value * 1e9).cast("decimal(20,0)"))


def within_bbox(lat: Column, lon: Column, bbox: list[float]) -> Column:
    min_lon, min_lat, max_lon, max_lat = (float(v) for v in bbox)
    return lon.between(min_lon, max_lon) & lat.between(min_lat, max_lat)


def geo_to_pixel(
    lat: Column, lon: Column, bbox: tuple[Column, Column, Column, Column], width: Column, height: Column
) -> tuple[Column, Column]:
    """Pixel (x, y) of a point on an image; y grows downwards.

    Points off the image are clamped to its edge, the far edge maps to width/height itself,
    and an image without extent gives nulls.
    """
    min_lon, min_lat, max_lon, max_lat = bbox
    has_extent = (max_lon != min_lon) & (max_lat != min_lat)
    clamped_lon = F.greatest(min_lon, F.least(lon, max_lon))
    clamped_lat = F.greatest(min_lat, F.least(lat, max_lat))
    east = (clamped_lon - min_lon) / (max_lon - min_lon)
    north = (clamped_lat - min_lat) / (max_lat - min_lat)
    x = F.when(has_extent, F.floor(east * width).cast("int"))
    y = F.when(has_extent, F.floor((F.lit(1.0) - north) * height).cast("int"))
    return x, y


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def visual_stretch(value: Column, low: float, high: float, gamma: float = 1.4) -> Column:
    """Map a band value to 0..255 with clamping and gamma correction."""
    unit = F.least(F.greatest((value - F.lit(low)) / F.lit(high - low), F.lit(0.0)), F.lit(1.0))
    return F.pow(unit, F.lit(1.0 / gamma)) * F.lit(255.0)
