"""Points, distances and the distance predicate."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions.fields import Field

# Mean earth radius in metres, and metres per distance unit.
EARTH_RADIUS_M = 6371008.7714
UNITS = {
    "mm": 0.001,
    "millimeters": 0.001,
    "cm": 0.01,
    "centimeters": 0.01,
    "in": 0.0254,
    "inch": 0.0254,
    "ft": 0.3048,
    "feet": 0.3048,
    "yd": 0.9144,
    "yards": 0.9144,
    "m": 1.0,
    "meters": 1.0,
    "km": 1000.0,
    "kilometers": 1000.0,
    "mi": 1609.344,
    "miles": 1609.344,
    "nmi": 1852.0,
    "NM": 1852.0,
    "nauticalmiles": 1852.0,
}


@dataclass(frozen=True)
class Point:
    lat: float
    lon: float

    def __post_init__(self):
        if not -90.0 <= self.lat <= 90.0:
            raise QueryError(f"latitude {self.lat} is outside [-90, 90]")
        if not -180.0 <= self.lon <= 180.0:
            raise QueryError(f"longitude {self.lon} is outside [-180, 180]")


def point(lat: Column, lon: Column, strict: bool = True) -> Column:
    """A point column from two coordinate columns. Out-of-range raises, or becomes null if not strict."""
    inside = lat.between(-90, 90) & lon.between(-180, 180)
    value = F.struct(lat.cast("double").alias("lat"), lon.cast("double").alias("lon"))
    outside = F.raise_error(F.concat(F.lit("coordinates out of range: "), lat, F.lit(", "), lon))
    missing = lat.isNull() | lon.isNull()
    return F.when(inside, value).when(~missing, outside if strict else F.lit(None))


def parse_distance(text: str) -> float:
    """``"1500km"`` -> metres. A bare number is metres."""
    found = re.fullmatch(r"\s*(\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)\s*([A-Za-z]*)\s*", str(text))
    unit = (found.group(2) or "m") if found else None
    if unit not in UNITS:
        raise QueryError(f"cannot read distance {text!r}")
    return float(found.group(1)) * UNITS[unit]


def check_point(field: Field) -> None:
    if not field.is_geo:
        raise QueryError(f"{field.name} is not a point field")


def distance(field: Field, origin: Point) -> Column:
    """Great-circle distance in metres (haversine)."""
    check_point(field)
    lat, lon = field.col.getField("lat"), field.col.getField("lon")
    half_lat = F.radians(lat - F.lit(origin.lat)) / 2
    half_lon = F.radians(lon - F.lit(origin.lon)) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.lit(math.cos(math.radians(origin.lat))) * F.cos(F.radians(lat)) * F.pow(
        F.sin(half_lon), 2
    )
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def geo_distance(field: Field, radius: str, origin: Point) -> Column:
    """Within ``radius`` of ``origin``, boundary included.

    A latitude/longitude box comes first: it is a plain comparison, so it reaches the scan and skips
    row groups; the exact distance then decides.
    """
    check_point(field)
    metres = parse_distance(radius)
    lat, lon = field.col.getField("lat"), field.col.getField("lon")
    # Widened a little so that rounding can never drop a point on the boundary.
    span = math.degrees(metres / EARTH_RADIUS_M) * (1 + 1e-9) + 1e-9
    south, north = origin.lat - span, origin.lat + span
    box = lat.between(max(south, -90.0), min(north, 90.0))
    if south > -90.0 and north < 90.0:
        reach = math.sin(math.radians(span)) / math.cos(math.radians(origin.lat))
        if span < 90.0 and reach < 1.0:
            width = math.degrees(math.asin(reach)) * (1 + 1e-9) + 1e-9
            west, east = origin.lon - width, origin.lon + width
            if west < -180.0:
                box = box & ((lon >= west + 360.0) | (lon <= east))
            elif east > 180.0:
                box = box & ((lon >= west) | (lon <= east - 360.0))
            else:
                box = box & lon.between(west, east)
    return box & (distance(field, origin) <= F.lit(metres))
