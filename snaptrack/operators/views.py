"""Filtered views, searches, facets, indicators and the export shape of the entity table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrack import constants as K
from snaptrack.functions.geo import coordinate_link
from snaptrack.functions.numbers import in_millions, is_numeric_label, parse_view_amount
from snaptrack.functions.text import contains_match
from snaptrack.functions.times import run_name_time
from snaptrack.operators.joins import lookup_join

#: Columns a free text is searched in.
SEARCHED = ("description", "official_name", "project_key", "contractor")


def filter_values(df: DataFrame, selections: Mapping[str, Sequence[str]]) -> DataFrame:
    """Keep rows whose columns hold one of the selected values; no selection keeps everything."""
    for column, values in selections.items():
        if values and column in df.columns:
            df = df.where(F.col(column).isin(*values))
    return df


def filter_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Closed range; rows without a number pass."""
    c = F.col(column)
    return df.where(c.isNull() | c.between(low, high))


def filter_labels(df: DataFrame, labels: Sequence[str], column: str = "label") -> DataFrame:
    """Selected lifecycle labels plus every numeric change; no selection keeps everything."""
    if not labels:
        return df
    c = F.col(column)
    return df.where(F.coalesce(c.isin(*labels), F.lit(False)) | is_numeric_label(c))


def search(df: DataFrame, query: str, columns: Sequence[str], regex: bool = True) -> DataFrame:
    """Rows where any of the present columns matches."""
    present = [c for c in columns if c in df.columns]
    if not query:
        return df
    hits = [contains_match(F.col(c), query, regex) for c in present]
    return df.where(reduce(Column.__or__, hits, F.lit(False)))


def view(
    df: DataFrame,
    *,
    regions: Sequence[str] = (),
    work_types: Sequence[str] = (),
    progress: tuple[float, float] = (0.0, 100.0),
    labels: Sequence[str] = (),
    query: str = "",
) -> DataFrame:
    """All view filters together; Catalyst merges them into one scan."""
    df = filter_values(df, {"region": regions})
    if "pct_now" in df.columns:
        df = filter_range(df, "pct_now", *progress)
    if "label" in df.columns:
        df = filter_labels(df, labels)
    df = filter_values(df, {"work_type": work_types})
    return search(df, query, SEARCHED)


def facet_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def tag_counts(df: DataFrame, column: str = "tag") -> DataFrame:
    """Rows per tag under its display name, and all of them, in one pass."""
    display = F.create_map(*[F.lit(x) for pair in K.TAG_DISPLAY.items() for x in pair])
    counted = df.groupBy(F.coalesce(F.col(column), F.lit("")).alias("tag")).agg(
        F.count("*").alias("works")
    )
    total = F.when(F.grouping("tag") == 1, F.lit(K.TAG_ALL_DISPLAY)).otherwise(
        F.coalesce(display[F.col("tag")], F.col("tag"))
    )
    return counted.rollup("tag").agg(total.alias("shown_as"), F.sum("works").cast("long").alias("works")).drop("tag")


def with_tag(df: DataFrame, tag: str | None, column: str = "tag") -> DataFrame:
    """One tab of the view: rows with the tag, or all rows for None."""
    return df if tag is None else df.where(F.coalesce(F.col(column), F.lit("")) == tag)


def kpis(df: DataFrame, label: str = "label", amount: str = "amount_total") -> DataFrame:
    """Totals, counts by lifecycle label, and the sum of readable amounts."""
    c = F.col(label)
    total = F.sum(parse_view_amount(F.col(amount)))
    sums = df.agg(
        F.count("*").alias("works"),
        F.count_if(c == K.LABEL_NEW).alias("new"),
        F.count_if(c.isin(K.LABEL_DONE, K.LABEL_PROBABLY_DONE)).alias("finished"),
        F.count_if(c == K.LABEL_GONE).alias("vanished"),
        F.round(F.coalesce(total, F.lit(0.0)), 2).alias("amount"),
    )
    return sums.withColumn("amount_millions", in_millions(F.col("amount")))


def column_plan(
    df: DataFrame, chosen: Sequence[str], shown_runs: int = K.SHOWN_RUNS, label: str = "label"
) -> list[str]:
    """Chosen columns, then those of the newest runs by date, oldest first, then the label; helpers
    stay hidden."""
    runs = sorted((c for c in df.columns if c.startswith(K.RUN_PREFIX)), key=run_name_time)[-shown_runs:]
    fixed = [*runs, *([label] if label in df.columns else [])]
    free = [c for c in chosen if c in df.columns and c not in fixed and not c.startswith("_")]
    return [*free, *fixed]


def display(df: DataFrame, chosen: Sequence[str], tag: str = "tag") -> DataFrame:
    """The table as shown: planned columns, the tag always visible, coordinates as links."""
    columns = column_plan(df, chosen)
    if tag in df.columns and tag not in columns:
        columns = [tag, *columns]
    shown = df.select(*columns)
    if "coordinate" in columns:
        shown = shown.withColumn("coordinate", coordinate_link(F.col("coordinate")))
    return shown


def exportable(df: DataFrame) -> DataFrame:
    """The view without helper columns (their names start with '_')."""
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def selected_rows(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in a selection, whatever the selection's size."""
    return lookup_join(df, keys.select(on).distinct(), [on], "left_semi")
