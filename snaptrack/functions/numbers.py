"""Amounts, percentages and their texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaptrack.constants import BLANK_AMOUNT
from snaptrack.functions.text import is_blank, strip

# Decimal literals only: a bare cast would also take 'nan', 'inf' or '12d'.
DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
NUMERIC_LABEL = r"^[+\-]?\d"


def fixed(c: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, rounded on the exact binary value, ties to even."""
    return F.call_function("format_number", c, F.lit("0." + "0" * digits))


def amount_text(c: Column) -> Column:
    """Shortest plain decimal text of a number, never with an exponent."""
    return F.call_function("format_number", c, F.lit("0.0" + "#" * 15))


def to_double(c: Column) -> Column:
    return F.when(c.rlike(DECIMAL), c.try_cast("double"))


def _drop(c: Column, what: str) -> Column:
    return F.replace(c, F.lit(what), F.lit(""))


def _comma_to_dot(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("."))


def parse_amount(c: Column) -> Column:
    """'23.532.434,20' or '2.3532434E7' to double; anything unreadable to null.

    Without an exponent every dot is a thousands separator, so '9532434.2' reads as 95324342.
    That is the contract of the source; `parse_amount_strict` reads a lone dot as decimal.
    """
    s = strip(c)
    scientific = F.contains(F.upper(s), F.lit("E")) & ~F.contains(s, F.lit(","))
    return (
        F.when(is_blank(s, BLANK_AMOUNT), F.lit(None).cast("double"))
        .when(scientific, fixed(to_double(s), 2).try_cast("double"))
        .otherwise(to_double(_comma_to_dot(_drop(s, "."))))
    )


def has_ambiguous_dot(c: Column) -> Column:
    """A lone dot that cannot be a thousands separator; counted as a data-quality signal."""
    return F.coalesce(strip(c).rlike(r"^[+-]?\d*\.(\d{0,2}|\d{4,})$"), F.lit(False))


def parse_amount_strict(c: Column) -> Column:
    return F.when(has_ambiguous_dot(c), to_double(strip(c))).otherwise(parse_amount(c))


def parse_view_amount(c: Column) -> Column:
    """Amount as stored in the entity table (dot or comma decimal)."""
    return to_double(strip(_comma_to_dot(c)))


def parse_pct(c: Column) -> Column:
    """'45%', '45.0' or '5,67' to double, else null."""
    return to_double(strip(_comma_to_dot(_drop(c, "%"))))


def format_delta(now: Column, before: Column) -> Column:
    """'+1.5%', '-0.3%', '0%' for an exact zero, '' when either side is missing."""
    delta = now - before
    return (
        F.when(delta > 0, F.concat(F.lit("+"), fixed(delta, 1), F.lit("%")))
        .when(delta < 0, F.concat(fixed(delta, 1), F.lit("%")))
        .when(delta == 0, F.lit("0%"))
        .otherwise(F.lit(""))
    )


def is_numeric_label(c: Column) -> Column:
    return F.coalesce(c.rlike(NUMERIC_LABEL), F.lit(False))


def in_millions(c: Column) -> Column:
    return F.when(c != 0, fixed(c / F.lit(1e6), 1)).otherwise(F.lit("N/D"))
