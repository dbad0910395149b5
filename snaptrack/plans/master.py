"""A state from an existing master: one wide row per work, with its tag and one column per run.

The newest run becomes the state's snapshot, all older ones go behind the horizon, so later runs,
also late ones, are merged as if the state had seen every run itself.

A cell tells that the work was there; a work with a blank cell was not in that run, but
- without any progress it counts as seen in the oldest run, since the master knows it;
- in the newest run the change column, where there is one, decides: a blank cell is a work without
  known progress unless that column calls the work finished or vanished.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrack import constants as K
from snaptrack.functions.numbers import parse_pct
from snaptrack.functions.text import is_blank, or_empty, strip
from snaptrack.functions.times import run_name_time
from snaptrack.operators import denylist, intervals, lifecycle
from snaptrack.operators import reconcile as R
from snaptrack.operators.history import last_run_of_day, latest_runs
from snaptrack.operators.shape import align_schema, as_text, migrate_flag
from snaptrack.plans.state import Job, State, delete
from snaptrack.schemas import ENTITY_COLUMNS, FACTS, PROGRESS, RECORDS
from snaptrack.session import job_settings

# Columns of the master that are none of a snapshot.
MASTER_TAG, MASTER_FLAG, MASTER_CHANGE = "Stato", "VTiger", "Differenza"


def entities_of(master: DataFrame) -> DataFrame:
    """Entities with signature, their tag (from the legacy flag if there is no other), the run columns and
    `change`; of rows that share a key the first by road code."""
    names = {**K.SNAPSHOT_HEADERS, MASTER_TAG: "tag", MASTER_CHANGE: "change"}
    renamed = master.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in master.columns])
    tagged = migrate_flag(renamed, MASTER_FLAG)
    whole = align_schema(tagged, [*ENTITY_COLUMNS, "change"])
    runs = [c for c in whole.columns if c.startswith(K.RUN_PREFIX)]
    return R.one_row_per_work(as_text(whole.select(*ENTITY_COLUMNS, "change", *runs)))


def import_master(state: State, master: DataFrame, entries: DataFrame | None = None, cache: DataFrame | None = None) -> None:
    """The first commit of a state, from a master and, if given, its deny-list and record cache."""
    job = Job(state, "import")
    if job.head.sequence:
        raise ValueError("a master can only begin a state")
    # The master is worked through once and read back for all that is drawn from it.
    scratch, spark = state.folder("import", job.sequence), state.spark
    taken = entities_of(master)
    with job_settings(spark):
        taken.write.mode("overwrite").option("compression", "zstd").parquet(scratch)
    rows = spark.read.schema(taken.schema).parquet(scratch)
    columns: dict[datetime, str] = {}
    for c in rows.columns:
        if c.startswith(K.RUN_PREFIX) and run_name_time(c) != datetime.min:
            columns[run_name_time(c)] = c
    times = sorted(columns)
    entities = job.write("entities", rows)
    if entries is not None:
        job.write("entries", denylist.compact(entries.withColumn("seq", F.lit(0)), (times[-1] if times else datetime.now()).date(), None))
    if cache is not None:
        job.write("cache", cache)

    calendar = spark.createDataFrame([(t,) for t in times], "run_ts timestamp")
    seen = _runs_of(rows, columns, times).select(*R.SIGNATURE, *ENTITY_COLUMNS, PROGRESS, "run_ts")
    newest = seen.where(F.col("run_ts") == F.lit(times[-1])) if times else seen
    observed = R.observations(job.write("snapshots", newest), F.col("run_ts"))
    older, moved = calendar, {}
    if len(times) > 1:
        older = calendar.where(F.col("run_ts") < F.lit(times[-1]))
        behind = intervals.encode(seen.where(F.col("run_ts") < F.lit(times[-1])), R.SIGNATURE)
        kept = job.write("stretches", behind.withColumn("open", F.col("valid_to") == F.lit(times[-2])))
        own = kept.withColumns({"pct_text": F.col(PROGRESS), "pct": parse_pct(F.col(PROGRESS))})
        records = lifecycle.stretch_records(own, calendar, R.SIGNATURE)
        moved = {"horizon_ts": times[-2], "stretches_since": job.sequence}
    else:
        # The master knows its works, but no run tells of them.
        unseen = entities.join(observed.select(*R.SIGNATURE), list(R.SIGNATURE), "left_anti")
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in RECORDS.fields if f.name not in R.SIGNATURE]
        records = unseen.select(*R.SIGNATURE, *nothing)
    records = job.write("horizon", records)
    days = latest_runs(last_run_of_day(calendar), 2).orderBy("rank").collect()
    before = F.lit(days[1].run_ts if len(days) > 1 else None).cast("timestamp")
    job.write("facts", lifecycle.facts_of(records, observed, before, R.SIGNATURE).select(*FACTS.names))

    rows_of = {r.run_ts: r.n for r in seen.groupBy("run_ts").agg(F.count("*").alias("n")).collect()} if times else {}
    runs = [
        {"run_ts": t, "run_date": t.date(), "updated_at": t, "total_rows": rows_of.get(t, 0), "kept_rows": rows_of.get(t, 0),
         "corrupt_rows": 0, "snapshots": job.sequence if t == times[-1] else 0}
        for t in reversed(times)
    ]
    job.commit(runs[1:], **{**(runs[0] if runs else {}), **moved})
    delete(state, [scratch])


def _runs_of(rows: DataFrame, columns: dict[datetime, str], times: list[datetime]) -> DataFrame:
    """One row per work and run it was in, with `run_ts` and progress."""
    gone = F.col("change").isin(K.LABEL_DONE, K.LABEL_PROBABLY_DONE, K.LABEL_GONE)
    known = "change" in rows.columns
    text = {t: or_empty(strip(F.col(c))) for t, c in columns.items()}
    blank = {t: is_blank(c) for t, c in text.items()}
    never = F.lit(True)
    for t in times:
        never = never & blank[t]
    told = F.lit(False)
    if known:
        # Where no work has a change, the column tells nothing.
        told = F.lit(bool(rows.where(~is_blank(F.col("change"))).limit(1).count()))
    cells = []
    for t in times:
        there = ~blank[t]
        if t == times[-1]:
            there = there | (told & ~gone)
        if t == times[0] and len(times) > 1:
            there = there | never
        cells.append(F.when(there, F.struct(F.lit(t).alias("run_ts"), text[t].alias(PROGRESS))))
    found = F.array_compact(F.array(*cells).cast(f"array<struct<run_ts:timestamp,{PROGRESS}:string>>"))
    return rows.withColumn("_cell", F.explode(found)).select(*rows.columns, "_cell.*").drop(*columns.values(), "change")
