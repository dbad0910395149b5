"""Long-form history: one row per entity and run.

A run table has at most one row per run. Where it is broadcast, its size is bounded by the
calendar (one row per day) or by an explicit limit, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snaptrack import constants as K
from snaptrack.functions.numbers import format_delta, parse_pct
from snaptrack.functions.text import is_blank
from snaptrack.functions.times import format_run_id, parse_run_id


def in_time(run_ts: Column) -> Column:
    """Order of runs: one that tells no time comes first."""
    return F.coalesce(run_ts, F.lit(datetime(1, 1, 2)))


def distinct_runs(history: DataFrame) -> DataFrame:
    return history.select("run_ts").where(F.col("run_ts").isNotNull()).distinct()


def run_calendar(history: DataFrame) -> DataFrame:
    """Every run with its date, its name and its chronological position (1 = oldest).

    Runs whose name tells no time (run_ts null) count as one run before all others. Positions are counted inside each month and shifted by the months before it, so the only
    global ordering is over calendar months.
    """
    month = F.date_trunc("month", "run_ts")
    runs = history.select("run_ts").distinct().withColumn("_month", month)
    inside = runs.withColumn("_in_month", F.row_number().over(W.partitionBy("_month").orderBy("run_ts")))
    months = runs.groupBy("_month").agg(F.count("*").alias("_runs"))
    shift = months.select(
        "_month",
        F.coalesce(
            F.sum("_runs").over(W.orderBy("_month").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    shift = F.broadcast(shift.withColumnRenamed("_month", "_of_month"))
    return inside.join(shift, F.col("_month").eqNullSafe(F.col("_of_month"))).select(
        "run_ts",
        F.to_date("run_ts").alias("run_date"),
        format_run_id(F.col("run_ts")).alias("run_name"),
        (F.col("_before") + F.col("_in_month")).cast("long").alias("position"),
    )


def latest_runs(runs: DataFrame, n: int) -> DataFrame:
    """The newest n runs with their rank (1 = newest): a bounded top-n, then ranked."""
    newest = runs.select("run_ts").orderBy(F.desc("run_ts")).limit(n)
    return newest.withColumn("rank", F.row_number().over(W.orderBy(F.desc("run_ts"))))


def latest_usable_run(runs: DataFrame, min_rows: int = 1) -> DataFrame:
    """The newest run that has rows (runs: run_ts, rows)."""
    return (
        runs.where(F.col("rows") >= min_rows).orderBy(F.desc("run_ts")).limit(1)
    )


def pending_runs(landed: DataFrame, ingested: DataFrame, on: str = "run_date") -> DataFrame:
    """Landed runs that the history does not hold yet."""
    return landed.join(ingested.select(on).distinct(), on, "left_anti")


def last_run_of_day(history: DataFrame) -> DataFrame:
    """One row per calendar day: its latest run."""
    return (
        history.where(F.col("run_ts").isNotNull())
        .groupBy(F.to_date("run_ts").alias("run_date"))
        .agg(F.max("run_ts").alias("run_ts"))
    )


def same_day_replace(history: DataFrame) -> DataFrame:
    """Drop every run that a later run of the same day replaced, for all entities. Rows whose run
    tells no time are replaced by none."""
    keep = F.broadcast(last_run_of_day(history).select(F.col("run_ts").alias("_kept")))
    joined = history.join(keep, F.col("run_ts") == F.col("_kept"), "left")
    return joined.where(F.col("_kept").isNotNull() | F.col("run_ts").isNull()).drop("_kept")


def retain_last_runs(history: DataFrame, n: int = K.RETAINED_RUNS) -> DataFrame:
    keep = F.broadcast(latest_runs(distinct_runs(history), n).select("run_ts"))
    return history.join(keep, "run_ts", "left_semi")


def expired_runs(runs: DataFrame, n: int = K.RETAINED_RUNS) -> DataFrame:
    """Runs that fall out of retention."""
    return runs.join(F.broadcast(latest_runs(runs, n).select("run_ts")), "run_ts", "left_anti")


def last_known(history: DataFrame, keys: Sequence[str], before: Column) -> DataFrame:
    """Progress of the last run before `before` in which an entity's text was not blank. A run that
    tells no time comes before all others."""
    earlier = F.col("run_ts").isNull() | (F.col("run_ts") < before)
    known = history.where(earlier & ~is_blank(F.col("pct_text")))
    return known.groupBy(*keys).agg(
        F.max("run_ts").alias("known_at"), F.max_by("pct", in_time(F.col("run_ts"))).alias("last_known")
    )


def run_delta(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change between the two latest runs of the whole table, for every entity in it.

    An entity absent from either of the two has no delta, whatever its own last runs were.
    """
    ranked = F.broadcast(latest_runs(distinct_runs(history), 2))
    paired = history.join(ranked, "run_ts", "left").groupBy(*keys).agg(
        F.max(F.when(F.col("rank") == 1, F.col("pct"))).alias("pct_now"),
        F.max(F.when(F.col("rank") == 2, F.col("pct"))).alias("pct_before"),
    )
    now, before = F.col("pct_now"), F.col("pct_before")
    return paired.select(
        *keys, "pct_now", "pct_before", (now - before).alias("delta"),
        format_delta(now, before).alias("delta_label"),
    )


def to_wide(
    history: DataFrame, keys: Sequence[str], runs: Sequence[datetime], value: str = "pct_text"
) -> DataFrame:
    """One column per run, named like the run, for an explicit list of runs."""
    names = [K.RUN_PREFIX + r.strftime("%d-%m-%Y_%H%M") for r in runs]
    if len(set(names)) != len(names):
        raise ValueError("two runs share the same minute")
    return (
        history.withColumn("_run", format_run_id(F.col("run_ts")))
        .groupBy(*keys)
        .pivot("_run", names)
        .agg(F.max(value))
    )


def newest_run_list(runs: DataFrame, n: int = K.SHOWN_RUNS) -> list[datetime]:
    """The newest n runs as a Python list, oldest first: the columns of a wide view."""
    return sorted(r.run_ts for r in latest_runs(runs, n).collect())


def run_list(runs: DataFrame) -> list[datetime]:
    """All runs as a Python list, oldest first; the calendar bounds it (one run per day)."""
    return sorted(r.run_ts for r in distinct_runs(runs).collect())


def to_long(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing wide history to rows; columns that name no run keep a null run_ts."""
    runs = [c for c in wide.columns if c.startswith(K.RUN_PREFIX)]
    cells = [F.struct(F.lit(r).alias("run_name"), F.col(r).alias("pct_text")) for r in runs]
    rows = F.array(*cells).cast("array<struct<run_name:string,pct_text:string>>")  # also of no run at all
    long = wide.select(*keys, F.explode(rows).alias("cell")).select(*keys, "cell.*")
    run_ts = parse_run_id(F.col("run_name"))
    return long.select(
        *keys, "run_name", run_ts.alias("run_ts"), run_ts.cast("date").alias("run_date"),
        "pct_text", parse_pct(F.col("pct_text")).alias("pct"),
    )
