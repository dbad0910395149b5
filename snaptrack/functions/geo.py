"""Coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaptrack.constants import MAP_LINK
from snaptrack.functions.numbers import fixed, to_double
from snaptrack.functions.text import is_blank, or_empty, strip


def format_coordinate(lat: Column, lng: Column) -> Column:
    """'38.701000, 16.472000'; '' when either is missing or both are zero."""
    usable = ~((lat == 0) & (lng == 0)) & ~F.isnan(lat) & ~F.isnan(lng)
    return or_empty(F.when(usable, F.concat(fixed(lat, 6), F.lit(", "), fixed(lng, 6))))


def coordinate_link(c: Column) -> Column:
    """Map link for a 'lat, lng' text; '' unless both parts are numbers."""
    parts = F.split(F.replace(c, F.lit(";"), F.lit(",")), ",")
    lat, lng = strip(F.get(parts, F.lit(0))), strip(F.get(parts, F.lit(1)))
    valid = ~is_blank(c) & to_double(lat).isNotNull() & to_double(lng).isNotNull()
    return or_empty(F.when(valid, F.concat(F.lit(MAP_LINK), lat, F.lit(","), lng)))
