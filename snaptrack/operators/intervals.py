"""History by stretches: one row per entity and unbroken run of runs in which nothing changed.

A row (keys, values, valid_from, valid_to) says that in every run of the calendar from `valid_from`
to `valid_to` the entity was there with these values. An unchanged entity keeps one row however
many runs pass, so the table grows with changes; any run comes back row for row.

Stretches are found with one shuffle by the keys: a row joins the one before it if the values are
the same and no run of the calendar lies between. The calendar (one row per run) is broadcast, as
are the positions taken from it. Rows whose run tells no time count as one run before all others.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snaptrack.operators.history import in_time, run_calendar
from snaptrack.operators.packing import only_texts, pack, with_unpacked

VALID = ("valid_from", "valid_to")


def _positions(runs: DataFrame) -> DataFrame:
    """One row per run: its time and its place in the calendar."""
    return run_calendar(runs.select("run_ts")).select(in_time(F.col("run_ts")).alias("_at"), F.col("position").alias("_position"))


def _placed(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """`rows` with the positions of both ends."""
    places = _positions(runs)
    for c, at in (("valid_from", "_first"), ("valid_to", "_last")):
        names = places.select(F.col("_at").alias(f"{at}_at"), F.col("_position").alias(at))
        rows = rows.join(F.broadcast(names), F.col(c) == F.col(f"{at}_at")).drop(f"{at}_at")
    return rows


def single_runs(history: DataFrame) -> DataFrame:
    """History rows (with a `run_ts`) as stretches of one run each."""
    at = in_time(F.col("run_ts"))
    return history.withColumns({"valid_from": at, "valid_to": at}).drop("run_ts")


def joined(rows: DataFrame, keys: Sequence[str], runs: DataFrame) -> DataFrame:
    """Stretches that touch and hold the same values become one. `runs` (run_ts) are all runs of the
    history; an entity has at most one row for any of them."""
    values = [c for c in rows.columns if c not in (*keys, *VALID)]
    order = W.partitionBy(*keys).orderBy("_first")
    packed = only_texts(rows, values)
    own = pack(values) if packed else F.struct(*values) if values else F.lit(True)
    goes_on = (F.lag("_last").over(order) + 1 == F.col("_first")) & F.lag("_values").over(order).eqNullSafe(F.col("_values"))
    flagged = _placed(rows.withColumn("_values", own).drop(*values), runs).withColumn(
        "_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)
    )
    stretch = flagged.withColumn("_stretch", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    found = stretch.groupBy(*keys, "_stretch").agg(
        F.any_value("_values").alias("_values"), F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to")
    )
    if packed:
        return with_unpacked(found, "_values", values).select(*rows.columns)
    shown = {c: F.col(f"_values.{c}") for c in values}
    return found.select(*[shown[c].alias(c) if c in shown else F.col(c) for c in rows.columns])


def encode(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stretches of a history with one row per entity and run."""
    return joined(single_runs(history), keys, history)


def as_of(stretches: DataFrame, run_ts: datetime) -> DataFrame:
    """The rows of one run of the calendar; the test goes down to the scan."""
    at = F.lit(run_ts)
    return stretches.where((F.col("valid_from") <= at) & (F.col("valid_to") >= at)).drop(*VALID).withColumn("run_ts", at)


def decode(stretches: DataFrame, runs: DataFrame) -> DataFrame:
    """The history again: one row per entity and run. `runs` is the calendar the rows were encoded with."""
    names = _positions(runs).select(F.col("_at").alias("run_ts"), "_position")
    each = _placed(stretches, runs).withColumn("_position", F.explode(F.sequence("_first", "_last")))
    return each.join(F.broadcast(names), "_position").drop("_position", "_first", "_last", *VALID)


def without_run(stretches: DataFrame, run_ts: datetime, runs: DataFrame) -> DataFrame:
    """Stretches that reach over a run, cut to end before it and to begin again after it."""
    at, time = F.lit(run_ts), in_time(F.col("run_ts"))
    near = runs.agg(F.max(F.when(time < at, time)).alias("before"), F.min(F.when(time > at, time)).alias("after")).first()
    low, high = F.col("valid_from"), F.col("valid_to")

    def piece(first: Column, last: Column) -> Column:
        return F.struct(first.cast("timestamp").alias("valid_from"), last.cast("timestamp").alias("valid_to"))

    known = [near.before is not None, near.after is not None]
    ends = [p for p, there in zip((piece(low, F.lit(near.before)), piece(F.lit(near.after), high)), known, strict=True) if there]
    parts = F.array(*ends) if ends else F.array().cast("array<struct<valid_from:timestamp,valid_to:timestamp>>")
    over = (low <= at) & (high >= at)
    cut = F.when(over, F.filter(parts, lambda p: p["valid_from"] <= p["valid_to"])).otherwise(F.array(piece(low, high)))
    others = [c for c in stretches.columns if c not in VALID]
    return stretches.select(*others, F.explode(cut).alias("_part")).select(*others, "_part.*")


def with_run(stretches: DataFrame, rows: DataFrame, run_ts: datetime, keys: Sequence[str], runs: DataFrame) -> DataFrame:
    """Stretches after a run came late, or again: `rows` are the run's, `runs` all runs with it."""
    cut = without_run(stretches, run_ts, runs)
    own = single_runs(rows.drop("run_ts").withColumn("run_ts", F.lit(run_ts)))
    return joined(cut.unionByName(own), keys, runs)
