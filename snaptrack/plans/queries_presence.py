"""Presence of the events' entities in runs, from bitmaps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrack.operators import history as H
from snaptrack.operators import presence as P
from snaptrack.plans import tables as t
from snaptrack.plans.registry import query
from snaptrack.sources.shared import new_folder


def _presence(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list]:
    """Register and presence table, written once: all days but the newest first, then that one as a run that
    arrives; and the days, oldest first."""
    history = t.table(spark, sf, "events").select(*t.ENTITY, F.date_trunc("day", "ts").alias("run_ts"))
    runs = H.run_list(history)
    newest = F.col("run_ts") == F.lit(runs[-1] if runs else None)
    cells = P.cells_for(history, t.ENTITY)
    earlier = P.numbered(history.where(~newest), t.ENTITY, cells)
    known = P.register(earlier, t.ENTITY)
    arrived = P.number_run(known, history.where(newest), t.ENTITY, cells)
    folder = new_folder(spark, "presence")
    known.unionByName(P.register(arrived, t.ENTITY)).distinct().write.parquet(f"{folder}/register")
    P.with_run(P.bitmaps(earlier), arrived).write.parquet(f"{folder}/bitmaps")
    return spark.read.parquet(f"{folder}/register"), spark.read.parquet(f"{folder}/bitmaps"), runs


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


_SQL = """
  WITH seen AS (SELECT DISTINCT user_id, event_type, date_trunc('day', ts) AS run FROM events),
  days AS (SELECT run, lead(run) OVER (ORDER BY run) AS next_run, max(run) OVER () AS newest FROM (SELECT DISTINCT run FROM seen))"""


@query(
    "presence_between_runs",
    _SQL
    + """, pairs AS (
            SELECT run AS older_run, next_run AS newer_run FROM days WHERE next_run IS NOT NULL
            UNION SELECT run, newest FROM days WHERE run < newest),
          sizes AS (SELECT run, count(*) AS n FROM seen GROUP BY run),
          shared AS (
            SELECT older_run, newer_run, count(b.user_id) AS n FROM pairs JOIN seen AS a ON a.run = older_run
              LEFT JOIN seen AS b ON b.run = newer_run AND b.user_id = a.user_id AND b.event_type = a.event_type
            GROUP BY older_run, newer_run)
          SELECT strftime(older_run, '%Y-%m-%d') AS older_run, strftime(newer_run, '%Y-%m-%d') AS newer_run,
            CAST(shared.n AS BIGINT) AS in_both, CAST(newer.n - shared.n AS BIGINT) AS only_newer,
            CAST(older.n - shared.n AS BIGINT) AS only_older
          FROM shared JOIN sizes AS older ON older.run = older_run JOIN sizes AS newer ON newer.run = newer_run""",
)
def presence_between_runs(spark, sf):
    """Every day against the next one and against the newest."""
    _, table, runs = _presence(spark, sf)
    pairs = [*zip(runs, runs[1:], strict=False), *[(r, runs[-1]) for r in runs[:-1]]]
    return P.between(table, pairs).select(_day("older_run"), _day("newer_run"), "in_both", "only_newer", "only_older")


@query(
    "presence_first_seen",
    _SQL
    + """, born AS (
            SELECT run, count(*) AS n FROM (SELECT min(run) AS run FROM seen GROUP BY user_id, event_type) GROUP BY run),
          sizes AS (SELECT run, count(*) AS entities FROM seen GROUP BY run)
          SELECT strftime(run, '%Y-%m-%d') AS run_ts, CAST(entities AS BIGINT) AS entities,
            CAST(coalesce(n, 0) AS BIGINT) AS first_seen,
            CAST(sum(coalesce(n, 0)) OVER (ORDER BY run) AS BIGINT) AS known
          FROM sizes LEFT JOIN born USING (run)""",
)
def presence_first_seen(spark, sf):
    """Per day: entities, those never seen before, and all seen so far."""
    _, table, _ = _presence(spark, sf)
    return P.first_seen(table).select(_day("run_ts"), "entities", "first_seen", "known")


@query(
    "presence_members",
    _SQL
    + """, last_two AS (SELECT max(run) AS newer, max(CASE WHEN next_run IS NOT NULL THEN run END) AS older FROM days)
          SELECT user_id, event_type,
            CASE WHEN bool_or(run = newer) AND bool_or(run = older) THEN 'both'
              WHEN bool_or(run = newer) THEN 'new' ELSE 'gone' END AS status
          FROM seen, last_two WHERE run IN (newer, older) GROUP BY user_id, event_type""",
)
def presence_members(spark, sf):
    """Who is in both of the last two days, in the newer only, in the older only."""
    known, table, runs = _presence(spark, sf)
    older, newer = runs[-2:]
    asked = {"both": ([older, newer], []), "new": ([newer], [older]), "gone": ([older], [newer])}
    parts = [
        P.members(known, table, present, absent).select(*t.ENTITY, F.lit(status).alias("status"))
        for status, (present, absent) in asked.items()
    ]
    return reduce(DataFrame.unionByName, parts)
