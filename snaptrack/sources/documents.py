"""JSON documents kept beside the tables: the record cache and the deny-list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptrack.constants import CACHE_FIELDS
from snaptrack.functions.text import or_empty
from snaptrack.operators.denylist import explode_entries
from snaptrack.schemas import CACHE_DOCUMENT, DENY_DOCUMENT


def explode_json_map(
    df: DataFrame, column: str, schema: T.MapType, key: str, value: str
) -> DataFrame:
    """One row per member of the JSON object in a text column."""
    keep = [c for c in df.columns if c != column]
    return df.select(*keep, F.explode(F.from_json(F.col(column), schema)).alias(key, value))


def scan_cache(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Cache files, one JSON object (key -> record) each, to one row per key.

    A file is parsed by one task, so a large cache is kept as a table, or with `multiline` off as
    files of one object per line, which split freely.
    """
    text = spark.read.text(path, wholetext=multiline)
    rows = explode_json_map(text, "value", CACHE_DOCUMENT, "project_key", "record")
    fields = [or_empty(F.col("record")[f]).alias(c) for f, c in CACHE_FIELDS.items()]
    return rows.select("project_key", *fields)


def parse_deny_document(text: Column) -> Column:
    return F.from_json(text, DENY_DOCUMENT)


def scan_denylist(spark: SparkSession, path: str) -> DataFrame:
    """Deny-list files of any of the three shapes to entries."""
    text = spark.read.text(path, wholetext=True)
    return explode_entries(text.select(parse_deny_document(F.col("value")).alias("d")), "d")


def write_denylist(entries: DataFrame, path: str) -> None:
    """Entries as JSON lines, each a document of the current shape with a single entry."""
    entry = F.struct(
        F.col("project_key").alias("cup"),
        F.col("region").alias("regione"),
        F.col("contractor").alias("impresa"),
        F.col("description").alias("descrizione"),
        F.col("added_on").alias("added_at"),
    )
    entries.select(F.to_json(F.struct(F.array(entry).alias("entries"))).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def scan_denylist_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path)
    return explode_entries(lines.select(parse_deny_document(F.col("value")).alias("d")), "d")
