"""Snapshot files of one run each."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptrack import constants as K
from snaptrack.functions.times import parse_run_file
from snaptrack.schemas import SNAPSHOT

BYTE_ORDER_MARK = "﻿"
# Doubled quotes inside quoted fields, nothing trimmed.
_CSV = {"header": True, "quote": '"', "escape": '"',
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SNAPSHOT,
    key: str | None = None,
    headers: Mapping[str, str] = K.SNAPSHOT_HEADERS,
    multiline: bool = True,
) -> DataFrame:
    """Snapshot CSV, every column a string, blanks as ''. Columns go by their header.

    A header is a column of `schema` or one of `headers`, which stand for one. Columns the file
    lacks are blank, others are left out; without the `key` column (the first of the schema)
    the file is refused, and so are files of one path that differ in their headers.
    `multiline` allows line breaks inside fields, at the price of one task per file.
    """
    found = spark.read.options(**_CSV, multiLine=multiline, enforceSchema=False).csv(path)
    by_name = {}
    for column in found.columns:
        name = column.lstrip(BYTE_ORDER_MARK).strip().strip('"')
        by_name.setdefault(headers.get(name, name), column)
    key = schema.names[0] if key is None else key
    if key not in by_name:
        raise ValueError(f"snapshot has no key column '{key}'")
    quoted = {n: F.col("`" + c.replace("`", "``") + "`") for n, c in by_name.items()}
    return found.select(*[quoted.get(n, F.lit("")).alias(n) for n in schema.names]).fillna("")


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """CSV with a byte order mark in front of every file's header.

    Line breaks inside fields make a file unsplittable, so files are kept small enough for one
    reading task each.
    """
    first, *others = df.columns
    marked = df.select(F.col(first).alias(BYTE_ORDER_MARK + first), *others)
    marked.write.mode("overwrite").options(
        **_CSV, emptyValue="", nullValue="", maxRecordsPerFile=rows_per_file
    ).csv(path)


def write_run(df: DataFrame, path: str) -> None:
    """Add or replace runs in a table partitioned by run (columns run_date and run_ts).

    Rows are brought together by run first, so a run is a few files; a run too large for one task is
    split by size.
    """
    (
        df.hint("rebalance", "run_date", "run_ts").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "run_ts")
        .parquet(path)
    )


def newest_usable_file(
    spark: SparkSession, folder: str, pattern: str = "*.csv", min_bytes: int = 0
) -> DataFrame:
    """Path and run of the newest file (by name).

    Whether a run has rows is known from its metadata (`history.latest_usable_run`); for foreign files
    without any, `min_bytes` (as K.MIN_FILE_BYTES) passes over shells of a header alone.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        .select("path", "length").where(F.col("length") >= min_bytes)
    )
    return files.agg(F.max("path").alias("path")).select(
        "path", parse_run_file(F.col("path")).alias("run_ts")
    )


def snapshot_health(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows, how many without a key, is the snapshot usable?"""
    blank = F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == ""
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(blank).alias("blank_keys"),
        (F.count("*") > 0).alias("usable"),
    )


def require_key(df: DataFrame, key: str) -> DataFrame:
    if key not in df.columns:
        raise ValueError(f"snapshot has no key column '{key}'")
    return df


def require_usable(df: DataFrame, key: str) -> DataFrame:
    """Raise before anything is written if the key column or all rows are missing."""
    require_key(df, key)
    if df.isEmpty():
        raise ValueError("snapshot has no rows")
    return df
