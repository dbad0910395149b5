"""History by stretches, and labels after retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from snaptrack.functions.numbers import parse_pct
from snaptrack.operators import changes as C
from snaptrack.operators import intervals as I
from snaptrack.operators import reconcile as R
from snaptrack.operators.dedupe import keep_first
from snaptrack.plans import tables as t
from snaptrack.plans.master import import_master
from snaptrack.plans.queries_runs import sql_labels
from snaptrack.plans.queries_works import RUN_2, SQL_ENTITY_VIEW, both_runs
from snaptrack.plans.registry import query
from snaptrack.plans.state import State, drop_expired_runs, drop_expired_versions, ingest_run, pin
from snaptrack.sources.shared import new_folder

# A run of the day of the newest one, and one before all others.
SAME_DAY, LATE = datetime(2024, 6, 1, 18, 0), datetime(2024, 4, 1, 8, 0)


def levels(spark, sf):
    """The events' history with progress in coarse levels, which change seldom."""
    history = t.events_history(spark, sf)
    pct = F.col("pct")
    level = F.when(pct.isNull(), F.lit("")).when(pct < 120, F.lit("50")).otherwise(F.lit("150"))
    return history.select(*t.ENTITY, "run_ts", level.alias("pct_text"))


_SQL_LEVELS = f"""
  WITH {t.sql_history('day')},
  leveled AS (
    SELECT user_id, event_type, run_ts,
      CASE WHEN pct IS NULL THEN '' WHEN pct < 120 THEN '50' ELSE '150' END AS pct_text FROM raw_history),
  places AS (SELECT run_ts, row_number() OVER (ORDER BY run_ts) AS place FROM (SELECT DISTINCT run_ts FROM raw_history))"""
_SQL_STRETCHES = """
    SELECT user_id, event_type, pct_text, strftime(min(run_ts), '%Y-%m-%d') AS valid_from, strftime(max(run_ts), '%Y-%m-%d') AS valid_to
    FROM (SELECT *, place - row_number() OVER (PARTITION BY user_id, event_type, pct_text ORDER BY place) AS island
          FROM leveled JOIN places USING (run_ts))
    GROUP BY user_id, event_type, pct_text, island"""


def _named(stretches):
    ends = [F.date_format(c, "yyyy-MM-dd").alias(c) for c in I.VALID]
    return stretches.select(*t.ENTITY, "pct_text", *ends)


@query("interval_history", f"{_SQL_LEVELS} {_SQL_STRETCHES}")
def interval_history(spark, sf):
    return _named(I.encode(levels(spark, sf), t.ENTITY))


@query(
    "interval_history_decoded",
    f"{_SQL_LEVELS} SELECT user_id, event_type, strftime(run_ts, '%Y-%m-%d') AS run, pct_text FROM leveled",
)
def interval_history_decoded(spark, sf):
    """Every run, back from the stretches."""
    history = levels(spark, sf)
    back = I.decode(I.encode(history, t.ENTITY), history)
    return back.select(*t.ENTITY, F.date_format("run_ts", "yyyy-MM-dd").alias("run"), "pct_text")


@query("interval_history_late_run", f"{_SQL_LEVELS} {_SQL_STRETCHES}")
def interval_history_late_run(spark, sf):
    """All runs but the middle one by stretches, then that one: the same stretches."""
    history = levels(spark, sf)
    runs = [r.run_ts for r in I.run_calendar(history).orderBy("position").collect()]
    late = F.col("run_ts") == F.lit(runs[len(runs) // 2])
    before = I.encode(history.where(~late), t.ENTITY)
    return _named(I.with_run(before, history.where(late), runs[len(runs) // 2], t.ENTITY, history))


@query(
    "labels_after_retention",
    f"""{t.SQL_WORKS},
    raw_history AS (
      SELECT sig_project, sig_region, sig_id, TIMESTAMP '2024-05-01 12:00:00' AS run_ts, progress AS pct_text, pct FROM s1
      UNION ALL SELECT sig_project, sig_region, sig_id, TIMESTAMP '2024-06-01 09:30:00', progress, pct FROM s2
      UNION ALL SELECT sig_project, sig_region, sig_id, TIMESTAMP '{SAME_DAY}', progress, pct FROM s2 WHERE right(work_id, 1) NOT IN ('1', '2')
      UNION ALL SELECT sig_project, sig_region, sig_id, TIMESTAMP '{LATE}', progress, pct FROM s1 WHERE right(work_id, 1) = '3'),
    {sql_labels(*R.SIGNATURE)}""",
)
def labels_after_retention(spark, sf):
    """Two runs, retention of one, then a run that repeats the newest day and one behind the horizon."""
    state = both_runs(spark, sf)
    drop_expired_runs(state, keep=1)
    digit = F.substring("work_id", -1, 1)
    for run_ts, status, kept in ((SAME_DAY, t.NEW, ~digit.isin("1", "2")), (LATE, t.OLD, digit == "3")):
        ingest_run(state, t.works_snapshot(spark, sf, status).where(kept), run_ts)
    return state.labelled().select(*R.SIGNATURE, "status", "last_known", "pct_now", "pct_before", "label")


@query(
    "history_after_retention",
    f"""{t.SQL_WORKS}
      SELECT sig_project, sig_region, sig_id, '2024-05-01 12:00' AS run, progress AS pct_text, pct FROM s1
      UNION ALL SELECT sig_project, sig_region, sig_id, '2024-06-01 09:30', progress, pct FROM s2
      UNION ALL SELECT sig_project, sig_region, sig_id, '2024-06-01 18:00', progress, pct FROM s2 WHERE right(work_id, 1) NOT IN ('1', '2')""",
)
def history_after_retention(spark, sf):
    """Progress of every run, the older ones behind the horizon."""
    state = both_runs(spark, sf)
    again = t.works_snapshot(spark, sf, t.NEW).where(~F.substring("work_id", -1, 1).isin("1", "2"))
    ingest_run(state, again, SAME_DAY)
    drop_expired_runs(state, keep=1)
    shown = state.history().select(*R.SIGNATURE, F.date_format("run_ts", "yyyy-MM-dd HH:mm").alias("run"), F.col("progress").alias("pct_text"))
    return shown.withColumn("pct", parse_pct(F.col("pct_text")))


_SHOWN = ("region", "contractor", "amount_total", "coordinate", "label")


@query(
    "changes_between_commits",
    f"""{SQL_ENTITY_VIEW}
      SELECT sig_project, sig_region, sig_id, CASE WHEN s1.work_id IS NULL THEN 'added' ELSE 'changed' END AS kind,
        CASE WHEN s1.work_id IS NULL THEN '' ELSE array_to_string(list_filter([
          {", ".join(f"CASE WHEN s1.{c} <> viewed.{c} THEN '{c}' END" for c in _SHOWN if c != "label")},
          CASE WHEN label <> 'Obra Nueva' THEN 'label' END], lambda x: x IS NOT NULL), ',') END AS columns,
        viewed.contractor AS contractor, label
      FROM viewed LEFT JOIN s1 USING (sig_project, sig_region, sig_id)
      WHERE s1.work_id IS NULL OR label <> 'Obra Nueva' OR {" OR ".join(f"s1.{c} <> viewed.{c}" for c in _SHOWN if c != "label")}""",
)
def changes_between_commits(spark, sf):
    """What the second run changed in what readers see: works, columns and new values."""
    state = both_runs(spark, sf)
    one, two = (state.at(n).labelled().select(*R.SIGNATURE, *_SHOWN) for n in (1, 2))
    feed = C.change_feed(one, two, R.SIGNATURE)
    return feed.select(*R.SIGNATURE, "kind", F.array_join("columns", ",").alias("columns"), "new.contractor", "new.label")


@query(
    "state_as_of_commit",
    t.SQL_WORKS + " SELECT sig_project, sig_region, sig_id, contractor, 'Obra Nueva' AS label, pct AS pct_now FROM s1",
)
def state_as_of_commit(spark, sf):
    """The pinned first commit, read after a second run and retention of one version."""
    state = both_runs(spark, sf)
    pin(state, 1)
    drop_expired_runs(state, keep=1)
    drop_expired_versions(state, keep=1)
    return state.at(1).labelled().select(*R.SIGNATURE, "contractor", "label", "pct_now")


def master(spark, sf):
    """A wide master of the older works: two runs, the legacy flag, some cells blank."""
    digit = F.substring("work_id", -1, 1)
    works = keep_first(t.works_snapshot(spark, sf, t.OLD), ["work_id"], ["road_code"])
    return works.withColumns({
        "VTiger": F.when(digit == "1", F.lit("Si")).otherwise(F.lit("")),
        "Avanz_01-04-2024": F.when(digit == "5", F.lit("")).otherwise(F.col("progress")),
        "Avanz_01-05-2024_1200": F.when(digit.isin("5", "7"), F.lit("")).otherwise(F.col("progress")),
    }).drop("progress")


@query(
    "master_into_state",
    f"""{t.SQL_WORKS},
    cells AS (
      SELECT *, CASE WHEN right(work_id, 1) = '5' THEN '' ELSE progress END AS one,
        CASE WHEN right(work_id, 1) IN ('5', '7') THEN '' ELSE progress END AS two FROM s1),
    raw_history AS (
      SELECT sig_project, sig_region, sig_id, TIMESTAMP '2024-04-01' AS run_ts, one AS pct_text,
        try_cast(replace(one, ',', '.') AS DOUBLE) AS pct FROM cells
      UNION ALL SELECT sig_project, sig_region, sig_id, TIMESTAMP '2024-05-01 12:00:00', two, try_cast(replace(two, ',', '.') AS DOUBLE)
        FROM cells WHERE two <> ''
      UNION ALL SELECT sig_project, sig_region, sig_id, TIMESTAMP '{RUN_2}', progress, pct FROM s2),
    labels AS (WITH {sql_labels(*R.SIGNATURE)})
    SELECT labels.*, CASE WHEN s1.work_id IS NOT NULL AND right(labels.sig_id, 1) = '1' THEN 'In VTiger' ELSE '' END AS tag
    FROM labels LEFT JOIN s1 USING (sig_project, sig_region, sig_id)""",
)
def master_into_state(spark, sf):
    """A state begun from a master, then the newer snapshot as its next run."""
    state = State(spark, new_folder(spark, "state"))
    import_master(state, master(spark, sf))
    ingest_run(state, t.works_snapshot(spark, sf, t.NEW), RUN_2)
    return state.labelled().select(*R.SIGNATURE, "status", "last_known", "pct_now", "pct_before", "label", "tag")
