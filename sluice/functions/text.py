"""Column expressions for text, keys, dates and points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean radius used for great-circle distances, in km (fixed value).
EARTH_RADIUS_KM = 6371.007180918475


def composite_key(*parts: Column, sep: str = "-") -> Column:
    """Lower-cased parts joined by ``sep``; a null part counts as empty text."""
    return F.lower(F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def strip_zeros(c: Column) -> Column:
    """Remove leading zeros of all-digit text, leave other text alone; zero itself stays ``0``."""
    return F.when(c.rlike("^[0-9]+$"), F.regexp_replace(c, "^0+(?=[0-9])", "")).otherwise(c)


def after_last(c: Column, marker: str) -> Column:
    """Text after the last ``marker``, or all of it when the marker is absent."""
    return F.substring_index(c, marker, -1)


def to_int(c: Column) -> Column:
    """Integer part of a number given as text; null when it is not a number."""
    return c.try_cast("double").try_cast("int")


def year_month(c: Column) -> Column:
    """``year * 100 + month`` of text that starts with yyyy-MM."""
    return to_int(F.substring(c, 1, 4)) * 100 + to_int(F.substring(c, 6, 2))


def distance(lat1: Column, lng1: Column, lat2: Column, lng2: Column, unit: str = "km") -> Column:
    """Great-circle distance (haversine) in m, km or rads."""
    a1, a2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(
        F.sin((F.radians(lng2) - F.radians(lng1)) / 2), 2
    )
    rads = 2 * F.asin(F.least(F.lit(1.0), F.sqrt(h)))
    scale = {"rads": 1.0, "km": EARTH_RADIUS_KM, "m": EARTH_RADIUS_KM * 1000}[unit]
    return rads * scale


_POINT = r"^\s*POINT\s*\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)\s*\)\s*$"


def point_lng(c: Column) -> Column:
    """Longitude of ``POINT (lng lat)`` text, null when the text is not a point."""
    return F.regexp_extract(c, _POINT, 1).try_cast("double")


def point_lat(c: Column) -> Column:
    return F.regexp_extract(c, _POINT, 2).try_cast("double")


def to_point(lat: Column, lng: Column) -> Column:
    return F.format_string("POINT (%f %f)", lng, lat)
