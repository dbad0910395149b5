"""Run identifiers and dates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaptrack.constants import RUN_PREFIX
from snaptrack.functions.text import strip

# How runs are written in column names and in file names.
COLUMN_RUN = "dd-MM-yyyy_HHmm"
FILE_RUN = "yyyyMMdd_HHmmss"


def _first_format(c: Column, *formats: str) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def parse_run_id(c: Column) -> Column:
    """'Avanz_01-07-2026_0900' (time optional, ISO dates too) to timestamp; else null."""
    body = F.regexp_replace(strip(c), "^" + RUN_PREFIX, "")
    return _first_format(body, "d-M-yyyy_HHmm", "d-M-yyyy", "yyyy-M-d_HHmm", "yyyy-M-d")


def run_name_time(name: str) -> datetime:
    """`parse_run_id` of a column name in Python; a name of no run comes before all others."""
    body = name.strip().removeprefix(RUN_PREFIX)
    for form in ("%d-%m-%Y_%H%M", "%d-%m-%Y", "%Y-%m-%d_%H%M", "%Y-%m-%d"):
        try:
            return datetime.strptime(body, form)
        except ValueError:
            continue
    return datetime.min


def format_run_id(c: Column) -> Column:
    return F.concat(F.lit(RUN_PREFIX), F.date_format(c, COLUMN_RUN))


def parse_run_file(c: Column) -> Column:
    """Run timestamp out of a file name '..._20260701_090015.csv'; else null."""
    return F.try_to_timestamp(F.regexp_extract(c, r"(\d{8}_\d{6})", 1), F.lit(FILE_RUN))


def format_run_file(c: Column) -> Column:
    return F.date_format(c, FILE_RUN)


def parse_date(c: Column) -> Column:
    """Both date spellings of the source: dd-MM-yyyy and yyyy-MM-dd."""
    return _first_format(strip(c), "dd-MM-yyyy", "yyyy-MM-dd").cast("date")
