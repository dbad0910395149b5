"""Which entities were in which run, as bitmaps.

Entities are dealt by hash into cells and numbered inside their cell in key order (the register:
keys, cell, part, bit). The presence table holds, per cell, part (up to 32,768 entities) and run, one
bitmap of 4 KB. Whether an entity is in both of two runs, in the newer only, in the older only, or
new to all runs is then a bit operation on a few bitmaps per cell: the history is read once to
build them and no more.

Null keys are values like any other, repeated rows set the same bit, and a run without a time counts
before all others. Numbers never change: later runs give new entities the next ones of their cell, so the
register and the bitmaps of earlier runs stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snaptrack.operators.history import in_time

#: Entities a cell is planned for: most of a bitmap is used, and cells seldom need a second part.
CELL_ENTITIES = 24_576
PLACE = ("cell", "part")


def cells_for(history: DataFrame, keys: Sequence[str]) -> int:
    """How many cells to deal the entities of a history into; one number, kept for all later runs. Any
    number gives the same results."""
    known = history.agg(F.approx_count_distinct(F.struct(*keys))).first()[0]
    return max(1, -(-known // CELL_ENTITIES))


def _cell(keys: Sequence[str], cells: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(cells))


def _placed(number: Column) -> list[Column]:
    return [F.bitmap_bucket_number(number).alias("part"), F.bitmap_bit_position(number).alias("bit")]


def numbered(history: DataFrame, keys: Sequence[str], cells: int) -> DataFrame:
    """Keys, run, cell, part and bit, one row per entity and run. Repeated rows are reduced before they
    are shuffled, so no entity is hot; then all goes to its cell."""
    rows = history.select(*keys, "run_ts").distinct().withColumn("cell", _cell(keys, cells))
    number = F.dense_rank().over(W.partitionBy("cell").orderBy(*keys)).cast("long")
    return rows.withColumn("_number", number).select(*keys, "run_ts", "cell", *_placed(F.col("_number")))


def register(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per entity of numbered rows: keys, cell, part and bit."""
    return rows.select("cell", "part", "bit", *keys).distinct().select(*keys, *PLACE, "bit")


def bitmaps(rows: DataFrame) -> DataFrame:
    """The presence table of numbered rows: cell, part, run_ts and bitmap; no further shuffle."""
    return rows.groupBy(*PLACE, "run_ts").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def number_run(known: DataFrame, snapshot: DataFrame, keys: Sequence[str], cells: int) -> DataFrame:
    """The rows of one later run (keys, run_ts) with their place; new entities take the numbers that
    follow in their cell, in key order. `known` is the register."""
    held = known.groupBy("cell").agg(
        F.max((F.col("part") - 1) * 32_768 + F.col("bit") + 1).alias("_held")
    )
    rows = snapshot.select(*keys, "run_ts").distinct().withColumn("cell", _cell(keys, cells))
    same = reduce(Column.__and__, [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("cell", *keys)])
    met = rows.alias("n").join(known.alias("k"), same, "left").select(
        *[F.col(f"n.{c}") for c in (*keys, "run_ts", "cell")], F.col("k.part").alias("_part"), F.col("k.bit").alias("_bit")
    )
    fresh = F.col("_part").isNull()
    # Known entities have their number; the window counts the new ones of a cell.
    place = F.dense_rank().over(W.partitionBy("cell", fresh).orderBy(*keys)).cast("long")
    placed = met.withColumn("_place", place).join(held, "cell", "left")
    number = F.coalesce(F.col("_held"), F.lit(0)) + F.col("_place")
    part, bit = _placed(number)
    return placed.select(
        *keys, "run_ts", "cell", F.coalesce("_part", part).alias("part"), F.coalesce("_bit", bit).alias("bit")
    )


def with_run(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The presence table with the bitmaps of a later, late or repeated run, given its numbered rows; a run
    that the table has already is replaced."""
    own = F.broadcast(rows.agg(F.min("run_ts").alias("_run"), F.count("*").alias("_rows")))  # one row
    same = F.col("run_ts").eqNullSafe(F.col("_run")) & (F.col("_rows") > 0)
    return table.join(own, same, "left_anti").unionByName(bitmaps(rows))


def sizes(table: DataFrame) -> DataFrame:
    """Entities per run."""
    return table.groupBy("run_ts").agg(F.sum(F.bitmap_count("bitmap")).alias("entities"))


def between(table: DataFrame, pairs: Sequence[tuple[datetime | None, datetime | None]]) -> DataFrame:
    """For stated pairs of runs (older_run, newer_run): how many entities are in both, in the newer only
    and in the older only. A run without entities counts none.

    The caller names the pairs one by one, so they are sent to every task; there each bitmap is taken
    once for every pair that names its run.
    """
    runs = ("older_run", "newer_run")
    spark = table.sparkSession
    asked = spark.createDataFrame(list(dict.fromkeys(pairs)), "older_run timestamp, newer_run timestamp")
    sides = [(*p, run, side) for p in dict.fromkeys(pairs) for run, side in zip(p, runs, strict=True)]
    named = spark.createDataFrame(sides, "older_run timestamp, newer_run timestamp, _run timestamp, side string")
    met = table.join(F.broadcast(named), F.col("run_ts").eqNullSafe(F.col("_run")))
    of = {c: F.bitmap_or_agg(F.when(F.col("side") == c, F.col("bitmap"))) for c in runs}
    each = met.groupBy(*runs, *PLACE).agg(
        F.bitmap_count(of["older_run"]).alias("older"),
        F.bitmap_count(of["newer_run"]).alias("newer"),
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("either"),
    )
    sums = each.groupBy(*runs).agg(*[F.sum(c).alias(c) for c in ("older", "newer", "either")])
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"s.{c}")) for c in runs]
    found = asked.alias("a").join(sums.alias("s"), same[0] & same[1], "left").select(
        *[F.col(f"a.{c}") for c in runs], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("older", "newer", "either")]
    )
    older, newer, either = F.col("older"), F.col("newer"), F.col("either")
    return found.select(
        *runs,
        (older + newer - either).alias("in_both"),
        (either - older).alias("only_newer"),
        (either - newer).alias("only_older"),
    )


def first_seen(table: DataFrame) -> DataFrame:
    """Per run: entities in it, new to all runs, and known up to and with it. Runs of a cell are
    gone through in time, so a cell holds one bitmap per run."""
    time = W.partitionBy(*PLACE).orderBy(in_time(F.col("run_ts")))
    so_far = F.bitmap_or_agg("bitmap").over(time.rowsBetween(W.unboundedPreceding, W.currentRow))
    counted = table.select(*PLACE, "run_ts", F.bitmap_count("bitmap").alias("own"), F.bitmap_count(so_far).alias("known"))
    gained = F.col("known") - F.lag("known", 1, 0).over(time)
    per_run = counted.withColumn("gained", gained).groupBy("run_ts").agg(
        F.sum("own").alias("entities"), F.sum("gained").alias("first_seen")
    )
    # One row per run from here on.
    so_far = F.sum("first_seen").over(W.orderBy(in_time(F.col("run_ts"))).rowsBetween(W.unboundedPreceding, W.currentRow))
    return per_run.withColumn("known", so_far)


def has_bit(bitmap: Column, bit: Column) -> Column:
    """Is a bit of a bitmap set?"""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, (bit % 8).cast("int")) == 1


def members(known: DataFrame, table: DataFrame, present: Sequence[datetime | None], absent: Sequence[datetime | None] = ()) -> DataFrame:
    """Register rows of the entities that are in all runs `present` and in none of `absent` (run times;
    at least one in `present`)."""
    if not present:
        raise ValueError("name a run in which the entities are")
    inside, outside = ({*runs} for runs in (present, absent))

    def named(runs: set) -> Column:
        return reduce(Column.__or__, [F.col("run_ts").eqNullSafe(F.lit(r)) for r in runs], F.lit(False))

    wanted = table.where(named(inside | outside))
    each = wanted.groupBy(*PLACE).agg(
        F.bitmap_and_agg(F.when(named(inside), F.col("bitmap"))).alias("_all"),
        F.bitmap_or_agg(F.when(named(outside), F.col("bitmap"))).alias("_any"),
        F.count_if(named(inside)).alias("_runs"),
    )
    whole = each.where(F.col("_runs") == len(inside)).drop("_runs")
    met = known.join(whole, list(PLACE))
    return met.where(has_bit(F.col("_all"), F.col("bit")) & ~has_bit(F.col("_any"), F.col("bit"))).select(*known.columns)
