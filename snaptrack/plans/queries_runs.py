"""Run-by-run history of the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from snaptrack.functions.numbers import parse_pct
from snaptrack.operators import history as H
from snaptrack.operators import views
from snaptrack.operators.lifecycle import label_history
from snaptrack.plans import tables as t
from snaptrack.plans.registry import query


def _run(c: str = "run_ts"):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias("run")


_DAY = f"WITH {t.sql_history('day')}"
_HOUR = f"WITH {t.sql_history('hour')}"
_SQL_RUN = "strftime(run_ts, '%Y-%m-%d %H:%M:%S') AS run"


@query(
    "run_calendar",
    """
    WITH runs AS (SELECT DISTINCT date_trunc('hour', ts) AS run_ts FROM events)
    SELECT strftime(run_ts, '%Y-%m-%d %H:%M:%S') AS run,
      'Avanz_' || strftime(run_ts, '%d-%m-%Y_%H%M') AS run_name,
      CAST(row_number() OVER (ORDER BY run_ts) AS BIGINT) AS position FROM runs""",
)
def run_calendar(spark, sf):
    runs = t.table(spark, sf, "events").select(F.date_trunc("hour", "ts").alias("run_ts"))
    return H.run_calendar(runs).select(_run(), "run_name", "position")


@query(
    "same_day_replace",
    _HOUR
    + f""" SELECT user_id, event_type, {_SQL_RUN}, pct FROM raw_history
          WHERE run_ts IN (SELECT max(run_ts) FROM raw_history GROUP BY date_trunc('day', run_ts))""",
)
def same_day_replace(spark, sf):
    current = H.same_day_replace(t.events_history(spark, sf, "hour"))
    return current.select(*t.ENTITY, _run(), "pct")


@query(
    "last_known_value",
    _DAY
    + """ , known AS (
            SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY run_ts DESC) AS rn
            FROM raw_history
            WHERE run_ts < (SELECT max(run_ts) FROM raw_history) AND pct_text <> '')
          SELECT user_id, event_type, strftime(run_ts, '%Y-%m-%d') AS known_on, pct AS last_known
          FROM known WHERE rn = 1""",
)
def last_known_value(spark, sf):
    history = t.events_history(spark, sf)
    current = t.table(spark, sf, "events").agg(F.date_trunc("day", F.max("ts")).alias("m"))
    known = H.last_known(history, t.ENTITY, current.scalar())
    return known.select(
        *t.ENTITY, F.date_format("known_at", "yyyy-MM-dd").alias("known_on"), "last_known"
    )


@query(
    "run_delta",
    _DAY
    + """ , ranked AS (SELECT run_ts, row_number() OVER (ORDER BY run_ts DESC) AS rk
                       FROM (SELECT DISTINCT run_ts FROM raw_history)),
          paired AS (
            SELECT user_id, event_type, max(CASE WHEN rk = 1 THEN pct END) AS pct_now,
              max(CASE WHEN rk = 2 THEN pct END) AS pct_before
            FROM raw_history JOIN ranked USING (run_ts) GROUP BY user_id, event_type)
          SELECT user_id, event_type, pct_now, pct_before, pct_now - pct_before AS delta,
            CASE WHEN pct_now > pct_before THEN '+' || printf('%.1f', pct_now - pct_before) || '%'
              WHEN pct_now < pct_before THEN printf('%.1f', pct_now - pct_before) || '%'
              WHEN pct_now = pct_before THEN '0%' ELSE '' END AS delta_label
          FROM paired""",
)
def run_delta(spark, sf):
    return H.run_delta(t.events_history(spark, sf), t.ENTITY)


@query(
    "history_pivot",
    _DAY
    + """ SELECT * FROM (PIVOT (SELECT user_id, event_type, 'Avanz_' || strftime(run_ts, '%d-%m-%Y_%H%M') AS run, pct_text FROM raw_history)
          ON run USING max(pct_text) GROUP BY user_id, event_type)""",
)
def history_pivot(spark, sf):
    days = t.table(spark, sf, "events").select(F.date_trunc("day", "ts").alias("run_ts"))
    return H.to_wide(t.events_history(spark, sf), t.ENTITY, H.run_list(H.distinct_runs(days)))


@query(
    "history_unpivot",
    _DAY
    + """ SELECT user_id, event_type, strftime(run_ts, '%Y-%m-%d %H:%M:%S') AS run, pct_text, pct
          FROM raw_history WHERE pct_text <> ''""",
)
def history_unpivot(spark, sf):
    wide = history_pivot(spark, sf)
    long = H.to_long(wide, t.ENTITY).where(F.col("pct_text") != "")
    return long.select(*t.ENTITY, _run(), "pct_text", "pct")


@query(
    "wide_view_last3",
    _DAY
    + f""" , ranked AS (SELECT run_ts, row_number() OVER (ORDER BY run_ts DESC) AS rk
                       FROM (SELECT DISTINCT run_ts FROM raw_history))
          SELECT user_id, event_type,
            max(CASE WHEN rk = 3 THEN pct_text END) AS third_last,
            max(CASE WHEN rk = 2 THEN pct_text END) AS second_last,
            max(CASE WHEN rk = 1 THEN pct_text END) AS latest
          FROM raw_history LEFT JOIN ranked USING (run_ts) GROUP BY user_id, event_type""",
)
def wide_view_last3(spark, sf):
    days = t.table(spark, sf, "events").select(F.date_trunc("day", "ts").alias("run_ts"))
    runs = H.newest_run_list(H.distinct_runs(days))
    wide = H.to_wide(t.events_history(spark, sf), t.ENTITY, runs)
    planned = views.column_plan(wide, t.ENTITY)
    return wide.select(*planned).toDF(*t.ENTITY, "third_last", "second_last", "latest")


@query(
    "latest_run",
    """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS run,
      CAST(count(*) AS BIGINT) AS rows FROM events
    GROUP BY date_trunc('day', ts) HAVING count(*) >= 1 ORDER BY date_trunc('day', ts) DESC LIMIT 1""",
)
def latest_run(spark, sf):
    runs = t.table(spark, sf, "events").groupBy(F.date_trunc("day", "ts").alias("run_ts")).agg(
        F.count("*").alias("rows")
    )
    return H.latest_usable_run(runs).select(_run(), "rows")


@query(
    "retain_last_n_runs",
    _DAY
    + f""" SELECT user_id, event_type, {_SQL_RUN}, pct_text FROM raw_history
          WHERE run_ts IN (SELECT DISTINCT run_ts FROM raw_history ORDER BY run_ts DESC LIMIT 5)""",
)
def retain_last_n_runs(spark, sf):
    kept = H.retain_last_runs(t.events_history(spark, sf))
    return kept.select(*t.ENTITY, _run(), "pct_text")


@query(
    "expired_runs",
    """
    SELECT strftime(run_ts, '%Y-%m-%d %H:%M:%S') AS run FROM
      (SELECT DISTINCT date_trunc('day', ts) AS run_ts FROM events) AS d
    WHERE run_ts NOT IN (SELECT DISTINCT date_trunc('day', ts) AS r FROM events
                         ORDER BY r DESC LIMIT 5)""",
)
def expired_runs(spark, sf):
    days = t.table(spark, sf, "events").select(F.date_trunc("day", "ts").alias("run_ts"))
    return H.expired_runs(H.distinct_runs(days)).select(_run())


@query(
    "pending_runs",
    """
    SELECT DISTINCT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS run FROM events
    WHERE date_trunc('hour', ts) NOT IN
      (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'purchase')""",
)
def pending_runs(spark, sf):
    hours = t.table(spark, sf, "events").select(F.date_trunc("hour", "ts").alias("run_ts"), "event_type")
    landed = H.distinct_runs(hours)
    ingested = hours.where(F.col("event_type") == "purchase").select("run_ts")
    return H.pending_runs(landed, ingested, on="run_ts").select(_run())


def sql_labels(*keys: str) -> str:
    """CTEs over raw_history (keys, run_ts, pct_text, pct), and the label of every entity."""
    own = ", ".join(keys)
    return f"""
  seen AS (
    SELECT *, run_ts = (SELECT max(run_ts) FROM raw_history) AS is_now,
      run_ts IN (SELECT max(run_ts) FROM raw_history GROUP BY date_trunc('day', run_ts)) AS counts,
      run_ts = (SELECT max(run_ts) FROM raw_history
                WHERE date_trunc('day', run_ts)
                  < (SELECT date_trunc('day', max(run_ts)) FROM raw_history)) AS is_before
    FROM raw_history),
  facts AS (
    SELECT {own}, bool_or(is_now) AS present, bool_or(NOT is_now) AS seen_before,
      arg_max(pct, run_ts) FILTER (counts AND NOT is_now AND pct_text <> '') AS last_known,
      max(pct) FILTER (is_now) AS pct_now, max(pct) FILTER (is_before) AS pct_before
    FROM seen GROUP BY {own})
  SELECT {own},
    CASE WHEN NOT present THEN 'gone' WHEN NOT seen_before THEN 'new' ELSE 'both' END AS status,
    last_known, pct_now, pct_before,
    CASE WHEN NOT present THEN CASE WHEN last_known >= 100 THEN 'Obra Conclusa'
        WHEN last_known >= 80 THEN 'Obra Conclusa (probable)' ELSE 'Obra Desaparecida' END
      WHEN NOT seen_before THEN 'Obra Nueva'
      WHEN pct_now > pct_before THEN '+' || printf('%.1f', pct_now - pct_before) || '%'
      WHEN pct_now < pct_before THEN printf('%.1f', pct_now - pct_before) || '%'
      WHEN pct_now = pct_before THEN '0%' ELSE '' END AS label
  FROM facts"""


_SQL_LABELS = sql_labels(*t.ENTITY)


@query("lifecycle_from_history", f"{_DAY}, {_SQL_LABELS}")
def lifecycle_from_history(spark, sf):
    return label_history(t.events_history(spark, sf), t.ENTITY)


@query("lifecycle_same_day_runs", f"{_HOUR}, {_SQL_LABELS}")
def lifecycle_same_day_runs(spark, sf):
    return label_history(t.events_history(spark, sf, "hour"), t.ENTITY)


@query(
    "filter_range_null_pass",
    """
    SELECT event_id, pct FROM
      (SELECT event_id, CASE WHEN value >= 5 THEN value END AS pct FROM events)
    WHERE pct IS NULL OR pct BETWEEN 20 AND 80""",
)
def filter_range_null_pass(spark, sf):
    pct = F.when(F.col("value") >= 5, F.col("value")).alias("pct")
    return views.filter_range(t.table(spark, sf, "events").select("event_id", pct), "pct", 20, 80)


@query(
    "parse_pct",
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS pct FROM events""",
)
def parse_pct_query(spark, sf):
    value, kind = t.text("value"), F.col("event_type")
    spelled = (
        F.when(kind == "error", F.concat(value, F.lit("d")))
        .when(kind == "click", F.concat(F.lit(" "), value, F.lit(" %")))
        .when(kind == "view", F.replace(value, F.lit("."), F.lit(",")))
        .otherwise(value)
    )
    return t.table(spark, sf, "events").select("event_id", parse_pct(spelled).alias("pct"))
