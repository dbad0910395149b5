"""Text cleaning and normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaptrack.constants import BLANK_TEXTS, LEGACY_TRUE, TAG_LOADED, TAG_OPEN

# Every Unicode whitespace character; SQL trim() alone knows only the plain space.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """Line breaks and tabs become one space, ends are stripped, null becomes ''."""
    return F.coalesce(strip(F.regexp_replace(c, r"[\r\n\t]+", " ")), F.lit(""))


def normalise(c: Column) -> Column:
    """Form in which texts are compared: stripped, lower case, null as ''."""
    return F.coalesce(F.lower(strip(c)), F.lit(""))


def is_blank(c: Column, *also: str) -> Column:
    """Null, empty, or one of the texts that stand for nothing. Never null itself.

    Most values show by their first character that they are none of those texts; only the
    others are stripped of every kind of whitespace, which is the costly part.
    """
    texts = (*BLANK_TEXTS, *also)
    starts = F.lit(WHITESPACE + "".join(t[:1] for t in texts))
    may_be = F.contains(starts, F.left(F.trim(c), F.lit(1)))
    return F.coalesce(may_be & strip(c).isin(*texts), F.lit(True))


def blank_to_null(c: Column, *also: str) -> Column:
    return F.when(~is_blank(c, *also), c)


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def first_token(c: Column) -> Column:
    """Text before the first comma or semicolon."""
    return or_empty(strip(F.split_part(F.replace(c, F.lit(";"), F.lit(",")), F.lit(","), F.lit(1))))


def legacy_flag_to_tag(c: Column) -> Column:
    return F.when(normalise(c).isin(*LEGACY_TRUE), F.lit(TAG_LOADED)).otherwise(F.lit(TAG_OPEN))


def contains_match(c: Column, query: str, regex: bool = True) -> Column:
    """Case-insensitive search anywhere in the text; a null text does not match."""
    pattern = query if regex else re.escape(query)
    return F.coalesce(c.rlike("(?iu)" + pattern), F.lit(False))
