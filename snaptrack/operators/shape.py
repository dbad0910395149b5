"""Raw record -> snapshot projection, schema alignment, scope filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrack import constants as K
from snaptrack.functions.geo import format_coordinate
from snaptrack.functions.numbers import amount_text, parse_amount, to_double
from snaptrack.functions.segments import first_of, segments_text
from snaptrack.functions.text import clean_text, legacy_flag_to_tag, or_empty, strip
from snaptrack.operators.dedupe import keep_last
from snaptrack.operators.joins import lookup_join
from snaptrack.schemas import RECORD_COLUMNS, SNAPSHOT_COLUMNS


def filter_min_amount(
    df: DataFrame, column: str, minimum: float = K.MIN_AMOUNT
) -> DataFrame:
    """Rows whose amount text reaches the minimum (inclusive); unreadable counts as zero."""
    return df.where(F.coalesce(parse_amount(F.col(column)), F.lit(0.0)) >= minimum)


def filter_scope(df: DataFrame, column: str, regions: Sequence[str] = K.REGIONS) -> DataFrame:
    return df.where(F.col(column).isin(*regions))


def union_regions(parts: Sequence[DataFrame]) -> DataFrame:
    """All regional result sets one after the other, duplicates kept."""
    return reduce(DataFrame.unionByName, parts)


def attach_marker(works: DataFrame, markers: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """lat/lng by work id; a later marker of the same id wins, unmatched works get null."""
    latest = keep_last(markers.where(F.col("id").isNotNull()), ["id"], order_by)
    return lookup_join(works.drop("lat", "lng"), latest.select("id", "lat", "lng"), ["id"])


def attach_roads(works: DataFrame, roads: DataFrame, on: Sequence[str]) -> DataFrame:
    """Region and road names; `roads` holds one row per key, works without a road are kept."""
    return lookup_join(works, roads, on)


def project_snapshot(raw: DataFrame) -> DataFrame:
    """One landed raw record per work and road -> the 27 snapshot columns, cleaned."""

    def amount(name: str) -> Column:
        given = F.when(~strip(F.col(name)).isin(*K.ZERO_AMOUNTS), F.col(name))
        return parse_amount(given).alias(name)

    def number(name: str) -> Column:
        return to_double(strip(F.col(name).cast("string")))

    segments = F.col("strade_list")
    columns = {
        "work_id": or_empty(F.col("id")),
        "region": or_empty(F.col("_regione")),
        "road_code": or_empty(F.col("_strada_cod")),
        "road_name": or_empty(F.col("_strada_nome")),
        "project_key": or_empty(strip(F.col("cup"))),
        "description": clean_text(F.col("descrizione")),
        "work_type": clean_text(F.col("tipo_lavoro")),
        "contractor": clean_text(F.col("impresa")),
        "amount_main": amount("importo_lav_principali"),
        "amount_total": amount("importo_lav_totale"),
        "delivered_on": or_empty(F.col("data_consegna_impresa")),
        "progress": or_empty(F.col("avanzamento_lavori")),
        "due_on": or_empty(F.col("ultimazione")),
        "km_from": first_of(segments, "DALKM"),
        "km_to": first_of(segments, "ALKM"),
        "segments": segments_text(segments),
        "coordinate": format_coordinate(number("lat"), number("lng")),
        **{name: F.lit("") for name in RECORD_COLUMNS},
    }
    return raw.select(*[columns[name].alias(name) for name in SNAPSHOT_COLUMNS])


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the form in which snapshots are stored and compared."""

    def text(name: str, kind: str) -> Column:
        c = F.col(name)
        return or_empty(amount_text(c) if kind == "double" else c.cast("string")).alias(name)

    return df.select(*[text(name, kind) for name, kind in df.dtypes])


def align_schema(
    df: DataFrame, columns: Sequence[str], history_prefix: str = K.RUN_PREFIX
) -> DataFrame:
    """Add absent columns as blanks, placed before the first history column."""
    history = [c for c in df.columns if c.startswith(history_prefix)]
    first_history = df.columns.index(history[0]) if history else len(df.columns)
    head, tail = df.columns[:first_history], df.columns[first_history:]
    absent = [c for c in columns if c not in df.columns]
    return df.select(*head, *[F.lit("").alias(c) for c in absent], *tail)


def migrate_flag(df: DataFrame, flag: str = "VTiger", tag: str = "tag") -> DataFrame:
    """Replace the legacy yes/no flag by the tag; an existing tag column is left as it is."""
    if tag not in df.columns:
        value = legacy_flag_to_tag(F.col(flag)) if flag in df.columns else F.lit(K.TAG_OPEN)
        df = df.withColumn(tag, value)
    return df.drop(flag).withColumn(tag, or_empty(F.col(tag)))
