"""Positions and distances as Column expressions; no UDFs."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Fixed values.
DISTANCE_RADIUS_KM = 6373.0
OFFSET_RADIUS_M = 6371000.0
LATITUDE_PATTERN = r"^(-?\d+(?:\.\d+)?)"
LONGITUDE_PATTERN = r"(-?\d+(?:\.\d+)?)$"
DISRUPTION_CENTRE = (47.37, 8.52)
DISRUPTION_RADIUS_KM = 0.1


def _col(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))


def pack_location(lat, lon) -> Column:
    """``lat,lon`` text."""
    return F.concat_ws(",", _col(lat).cast("string"), _col(lon).cast("string"))


def split_location(location, as_type: str = "float") -> tuple[Column, Column]:
    """Latitude and longitude from ``lat,lon`` text: the number the text begins
    with and the one it ends with, NULL when there is none.

    The longitude of ``47.0,8.5e-05`` is -5, the trailing number; callers rely on
    these patterns, so the exponent is not read.
    """
    text = _col(location)

    def number(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast(as_type)

    return number(LATITUDE_PATTERN), number(LONGITUDE_PATTERN)


def geo_distance_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in kilometres."""
    phi1, phi2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin((F.radians(_col(lon2)) - F.radians(_col(lon1))) / 2)
    a = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    return F.lit(2 * DISTANCE_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def bounding_box(lat, lon, centre: tuple[float, float], radius_km: float) -> Column:
    """Range test that holds for every position within ``radius_km``.

    It compares stored columns with literals, so it reaches the Parquet scan.
    Longitude is not bounded where the circle meets a pole or the date line.
    """
    angle = radius_km / DISTANCE_RADIUS_KM
    slack = 1e-9
    d_lat = math.degrees(angle) + slack
    lat0, lon0 = centre
    box = _col(lat).between(lat0 - d_lat, lat0 + d_lat)
    if abs(lat0) + d_lat >= 90:
        return box
    d_lon = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat0))))) + slack
    if abs(lon0) + d_lon >= 180:
        return box
    return box & _col(lon).between(lon0 - d_lon, lon0 + d_lon)


def within_radius(lat, lon, centre: tuple[float, float], radius_km: float) -> Column:
    """Closer to ``centre`` than ``radius_km`` (strict)."""
    distance = geo_distance_km(lat, lon, *centre)
    return bounding_box(lat, lon, centre, radius_km) & (distance < radius_km)


def disrupted(lat, lon, enabled, centre: tuple[float, float] = DISRUPTION_CENTRE,
              radius_km: float = DISRUPTION_RADIUS_KM) -> Column:
    """True inside the disrupted area while the disruption is on."""
    flag = enabled if isinstance(enabled, Column) else F.lit(bool(enabled))
    return F.coalesce(flag & within_radius(lat, lon, centre, radius_km), F.lit(False))


def offset_position(lat, lon, dx_m, dy_m) -> tuple[Column, Column]:
    """Position ``dx_m`` east and ``dy_m`` north, on a plane touching the start."""
    metres_per_degree = OFFSET_RADIUS_M * math.pi / 180
    lat, lon = _col(lat), _col(lon)
    new_lat = lat + _col(dy_m) / F.lit(metres_per_degree)
    new_lon = lon + _col(dx_m) / (F.cos(F.radians(lat)) * F.lit(metres_per_degree))
    return new_lat, new_lon


def within_disk(dx, dy, radius) -> Column:
    """Offset no longer than ``radius``."""
    return F.hypot(_col(dx), _col(dy)) <= _col(radius)
