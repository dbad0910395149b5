"""Lifecycle label of every entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snaptrack import constants as K
from snaptrack.functions.numbers import format_delta
from snaptrack.functions.text import is_blank
from snaptrack.operators import history as H
from snaptrack.operators.reconcile import GONE, NEW


def label(
    status: Column,
    last_known: Column,
    delta_label: Column,
    done_at: float = K.DONE_AT,
    probably_done_at: float = K.PROBABLY_DONE_AT,
) -> Column:
    """New, finished / probably finished / vanished by last known progress, else the delta."""
    gone = status == GONE
    return (
        F.when(status == NEW, F.lit(K.LABEL_NEW))
        .when(gone & (last_known >= done_at), F.lit(K.LABEL_DONE))
        .when(gone & (last_known >= probably_done_at), F.lit(K.LABEL_PROBABLY_DONE))
        .when(gone, F.lit(K.LABEL_GONE))
        .otherwise(delta_label)
    )


def history_facts(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per entity: first run ever seen, presence now, last known progress, the two latest values.

    One aggregation over the raw history. A run replaced on the same day adds no progress but
    still counts as seen. The rank table has one row per day and is joined by broadcast.
    """
    days = H.last_run_of_day(history)
    newest = H.latest_runs(days, 2)
    ranked = days.select("run_ts").join(F.broadcast(newest), "run_ts", "left").select(
        "run_ts", F.coalesce("rank", F.lit(0)).alias("rank")
    )
    rows = history.join(F.broadcast(ranked), "run_ts", "left")
    # Null rank: replaced on its own day. 1: newest run. 2: the run before. 0: older, or of no time.
    rank, pct = F.when(F.col("run_ts").isNull(), F.lit(0)).otherwise(F.col("rank")), F.col("pct")
    known_at = F.when((rank != 1) & ~is_blank(F.col("pct_text")), H.in_time(F.col("run_ts")))
    return rows.groupBy(*keys).agg(
        F.coalesce(F.max(rank == 1), F.lit(False)).alias("present"),
        F.max(F.when(rank.isNull() | (rank != 1), F.lit(True))).isNotNull().alias("seen_before"),
        F.max_by("pct", known_at).alias("last_known"),
        F.max(F.when(rank == 1, pct)).alias("pct_now"),
        F.coalesce(F.max((rank == 1) & ~is_blank(F.col("pct_text"))), F.lit(False)).alias("now_known"),
        F.max(F.when(rank == 2, pct)).alias("pct_before"),
    )


def counted_runs(runs: DataFrame) -> DataFrame:
    """(run_ts, counted_at) of every run: the newest run up to it that no later run of its day replaced."""
    days = H.last_run_of_day(runs).select(F.col("run_ts").alias("_last"))
    marked = H.distinct_runs(runs).join(F.broadcast(days), F.col("run_ts") == F.col("_last"), "left")
    return marked.select("run_ts", F.max("_last").over(W.orderBy("run_ts")).alias("counted_at"))


def _record(at: Column, known: Column, pct: Column) -> list[Column]:
    known_at = F.when(known, at)
    return [
        F.max(at).alias("seen_at"), F.max_by(pct, at).alias("seen_pct"),
        F.max(known_at).alias("known_at"), F.max_by(pct, known_at).alias("known_pct"),
    ]


def fact_records(history: DataFrame, runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a block of runs tells of its entities' labels: one row per entity seen in any of them.

    The newest counted run with the entity and its progress there, and the newest in which the
    progress was known. Records of any blocks of one history merge in any order and grouping
    (`merge_records`); `runs` are all runs of the history, by which a run counts or was replaced.
    """
    counted = counted_runs(runs).where(F.col("counted_at") == F.col("run_ts")).select("counted_at")
    rows = history.join(F.broadcast(counted), F.col("run_ts") == F.col("counted_at"), "left")
    return rows.groupBy(*keys).agg(*_record(F.col("counted_at"), ~is_blank(F.col("pct_text")), F.col("pct")))


def stretch_records(stretches: DataFrame, runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`fact_records` of interval-encoded runs (keys, pct_text, pct, valid_from, valid_to): each stretch
    stands for the newest run in it that counts, without being taken apart."""
    ends = counted_runs(runs).withColumnRenamed("run_ts", "_end")
    rows = stretches.join(F.broadcast(ends), F.col("valid_to") == F.col("_end"), "left")
    at = F.when(F.col("counted_at") >= F.col("valid_from"), F.col("counted_at"))
    return rows.groupBy(*keys).agg(*_record(at, ~is_blank(F.col("pct_text")), F.col("pct")))


def merge_records(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One record per entity from those of several blocks."""
    return records.groupBy(*keys).agg(
        F.max("seen_at").alias("seen_at"), F.max_by("seen_pct", "seen_at").alias("seen_pct"),
        F.max("known_at").alias("known_at"), F.max_by("known_pct", "known_at").alias("known_pct"),
    )


def facts_of(records: DataFrame, newest: DataFrame, before: Column, keys: Sequence[str]) -> DataFrame:
    """Facts from the newest run's observations and the records of all other runs; `before` is the
    last run of the day before the newest run's that has one."""
    old = records.select(*keys, F.struct(*[c for c in records.columns if c not in keys]).alias("old"))
    new = newest.select(*keys, F.struct("pct", "pct_text").alias("new"))
    was, now = F.col("old"), F.col("new")
    return old.join(new, list(keys), "full_outer").select(
        *keys,
        now.isNotNull().alias("present"),
        was.isNotNull().alias("seen_before"),
        was["known_pct"].alias("last_known"),
        now["pct"].alias("pct_now"),
        (now.isNotNull() & ~is_blank(now["pct_text"])).alias("now_known"),
        F.when(was["seen_at"] == before, was["seen_pct"]).alias("pct_before"),
    )


def label_history(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Label every entity from its history alone (columns: keys, run_ts, pct_text, pct)."""
    return label_facts(history_facts(history, keys), keys)


def label_facts(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Status and label of every entity from its facts, however these were come by."""
    status = (
        F.when(~F.col("present"), F.lit(GONE))
        .when(~F.col("seen_before"), F.lit(NEW))
        .otherwise(F.lit("both"))
    )
    delta = format_delta(F.col("pct_now"), F.col("pct_before"))
    return facts.select(
        *keys, status.alias("status"), "last_known", "pct_now", "pct_before",
        label(status, F.col("last_known"), delta).alias("label"),
    )
