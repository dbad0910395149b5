"""Run metadata: one row per run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_record(
    raw: DataFrame, kept: Column, run_ts: datetime, updated_at: str, regions: Sequence[str]
) -> DataFrame:
    """Metadata of a run in one pass: source freshness, rows before and after the filter."""
    stamp = F.lit(run_ts)
    updated, total, left, _ = run_counts(F.lit(True), kept, F.lit(False), updated_at)
    return raw.agg(
        stamp.alias("run_ts"), stamp.cast("date").alias("run_date"), updated,
        F.lit(", ".join(regions)).alias("regions"), total, left,
    )


def run_counts(in_scope: Column, kept: Column, broken: Column, updated_at: str) -> list[Column]:
    """Source freshness, rows in scope, rows kept and rows that could not be read, as aggregates: to
    count on their own or while the rows are written (`DataFrame.observe`)."""
    return [
        F.max(updated_at).cast("timestamp").alias("updated_at"),
        F.count_if(in_scope).alias("total_rows"),
        F.count_if(kept).alias("kept_rows"),
        F.count_if(broken).alias("corrupt_rows"),
    ]
