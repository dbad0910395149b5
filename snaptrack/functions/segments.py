"""Nested road segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaptrack.functions.text import or_empty


def segments_text(
    segments: Column, code: str = "CODICE_STRADA", start: str = "DALKM", end: str = "ALKM"
) -> Column:
    """'CODE from–to; CODE from–to', '' for a missing list."""

    def one(s: Column) -> Column:
        return F.concat(
            or_empty(s[code]), F.lit(" "), or_empty(s[start]), F.lit("–"), or_empty(s[end])
        )

    return or_empty(F.array_join(F.transform(segments, one), "; "))


def first_of(segments: Column, field: str) -> Column:
    return or_empty(F.get(segments, F.lit(0))[field])
