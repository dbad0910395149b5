"""Incremental ingest of landed snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrack.functions.numbers import parse_pct
from snaptrack.operators.lifecycle import label_history
from snaptrack.plans import tables as t
from snaptrack.plans.queries_runs import _DAY, _SQL_LABELS, _SQL_RUN
from snaptrack.plans.registry import query
from snaptrack.sources.shared import new_folder
from snaptrack.streaming.ingest import current_history, read_log, stream_to_log

ORDER = ["ts", "event_id"]
FILES_PER_BATCH = 1000


def observe(rows: DataFrame) -> DataFrame:
    value = F.col("value")
    text = F.when(value < 5, F.lit("")).otherwise(F.replace(t.text("value"), F.lit("."), F.lit(",")))
    return rows.select(
        *t.ENTITY, F.date_trunc("day", "ts").alias("run_ts"), *ORDER, text.alias("pct_text")
    )


def _ingest(spark, sf) -> str:
    """Streams the events file of the table folder into a fresh state folder."""
    state = new_folder(spark, "stream")
    schema = t.table(spark, sf, "events").schema
    stream_to_log(
        spark, f"{sf}/events.parquet*", state, schema, t.ENTITY, ORDER, observe, FILES_PER_BATCH
    )
    return state


@query(
    "stream_ingest_snapshots",
    _DAY + f" SELECT user_id, event_type, {_SQL_RUN}, pct_text FROM raw_history",
)
def stream_ingest_snapshots(spark, sf):
    history = current_history(spark, _ingest(spark, sf), t.ENTITY, ORDER)
    run = F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("run")
    return history.select(*t.ENTITY, run, "pct_text")


@query("stream_lifecycle", f"{_DAY}, {_SQL_LABELS}")
def stream_lifecycle(spark, sf):
    log = read_log(spark, _ingest(spark, sf), t.ENTITY, ORDER)
    return label_history(log.withColumn("pct", parse_pct(F.col("pct_text"))), t.ENTITY)
