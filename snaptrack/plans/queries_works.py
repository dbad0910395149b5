"""Two snapshots of works: matching, merging, labelling."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrack.functions.numbers import format_delta, parse_pct
from snaptrack.operators import denylist as D
from snaptrack.operators import reconcile as R
from snaptrack.operators import views
from snaptrack.operators.dedupe import keep_first
from snaptrack.operators.lifecycle import label
from snaptrack.plans import tables as t
from snaptrack.plans.registry import query
from snaptrack.plans.state import State, ingest_run, rebuild_entities, save_tags
from snaptrack.schemas import MERGE_COLUMNS
from snaptrack.sources.shared import new_folder
from snaptrack.streaming.ingest import stream_into_state

RUN_1, RUN_2 = datetime(2024, 5, 1, 12, 0), datetime(2024, 6, 1, 9, 30)
LANDED_FILES = 12
# Bytes of a landed file's row group before compression: tasks share a file by its row groups, and a batch is one file.
ROW_GROUP = 8 << 20


def snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Both snapshots, one row per work each."""
    return tuple(R.one_row_per_work(t.works_snapshot(spark, sf, s)) for s in (t.OLD, t.NEW))


def matched(spark: SparkSession, sf: str) -> DataFrame:
    return R.match(*snapshots(spark, sf))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    before, now = parse_pct(F.col("old_progress")), parse_pct(F.col("new_progress"))
    newer = (F.col("status") == R.NEW) | ((F.col("status") == R.BOTH) & R.updates("amount_total"))
    amount = F.when(newer, F.col("new_amount_total")).otherwise(F.col("old_amount_total"))
    return matched(spark, sf).select(
        *R.SIGNATURE,
        "status",
        label(F.col("status"), before, format_delta(now, before)).alias("label"),
        amount.alias("amount_total"),
        now.alias("pct_now"),
    )


@query(
    "reconcile_status",
    t.SQL_MATCHED + " SELECT sig_project, sig_region, sig_id, status FROM matched",
)
def reconcile_status(spark, sf):
    return matched(spark, sf).select(*R.SIGNATURE, "status")


@query(
    "reconcile_counts",
    t.SQL_MATCHED + " SELECT status, CAST(count(*) AS BIGINT) AS works FROM matched GROUP BY status",
)
def reconcile_counts(spark, sf):
    return R.status_counts(matched(spark, sf))


@query(
    "lifecycle_label",
    t.SQL_MATCHED + " SELECT sig_project, sig_region, sig_id, status, label FROM labelled",
)
def lifecycle_label(spark, sf):
    return labelled(spark, sf).select(*R.SIGNATURE, "status", "label")


@query(
    "lifecycle_summary",
    t.SQL_MATCHED
    + """ SELECT CASE WHEN label LIKE '+%' THEN 'up' WHEN label LIKE '-%' THEN 'down'
            ELSE label END AS outcome, CAST(count(*) AS BIGINT) AS works
          FROM labelled GROUP BY 1""",
)
def lifecycle_summary(spark, sf):
    shown = F.col("label")
    outcome = F.when(shown.startswith("+"), F.lit("up")).when(shown.startswith("-"), F.lit("down"))
    return (
        labelled(spark, sf)
        .groupBy(outcome.otherwise(shown).alias("outcome"))
        .agg(F.count("*").alias("works"))
    )


def entity_view(spark: SparkSession, sf: str) -> DataFrame:
    """Merged entities with label, latest progress and a tag, as readers see them."""
    merged = R.merge_nonblank(matched(spark, sf), _TEXT_COLUMNS, owned=("work_id",)).drop("status")
    facts = labelled(spark, sf).select(*R.SIGNATURE, "label", "pct_now")
    return merged.join(facts, list(R.SIGNATURE)).withColumn("tag", F.lit(""))


_KEYS = "SELECT sig_project, sig_region, sig_id FROM "


@query("keys_in_both", f"{t.SQL_WORKS} {_KEYS} s1 INTERSECT {_KEYS} s2")
def keys_in_both(spark, sf):
    return R.keys_in_both(*snapshots(spark, sf))


@query("keys_only_new", f"{t.SQL_WORKS} {_KEYS} s2 EXCEPT {_KEYS} s1")
def keys_only_new(spark, sf):
    old, new = snapshots(spark, sf)
    return R.keys_only_in(new, old)


@query("keys_only_old", f"{t.SQL_WORKS} {_KEYS} s1 EXCEPT {_KEYS} s2")
def keys_only_old(spark, sf):
    return R.keys_only_in(*snapshots(spark, sf))


_TEXT_COLUMNS = (
    "region", "road_code", "road_name", "project_key", "description", "work_type", "contractor",
    "amount_main", "amount_total", "delivered_on", "due_on", "km_from", "km_to", "segments",
    "coordinate",
)
_BLANK = "('', 'None', 'nan', '0.000000, 0.000000')"


def _sql_merged(c: str) -> str:
    return (
        f"CASE WHEN s1.work_id IS NULL THEN s2.{c} WHEN s2.work_id IS NULL THEN s1.{c}"
        f" WHEN trim(s2.{c}) IN {_BLANK} THEN s1.{c} ELSE s2.{c} END AS {c}"
    )


SQL_ENTITY_VIEW = (
    t.SQL_MATCHED
    + ", merged AS (SELECT sig_project, sig_region, sig_id, coalesce(s1.work_id, s2.work_id) AS work_id, "
    + ", ".join(_sql_merged(c) for c in _TEXT_COLUMNS)
    + """ FROM s1 FULL OUTER JOIN s2 USING (sig_project, sig_region, sig_id)),
    viewed AS (SELECT merged.*, label, pct2 AS pct_now
      FROM merged JOIN labelled USING (sig_project, sig_region, sig_id))"""
)


@query(
    "merge_nonblank",
    t.SQL_WORKS
    + " SELECT sig_project, sig_region, sig_id, coalesce(s1.work_id, s2.work_id) AS work_id, "
    + ", ".join(_sql_merged(c) for c in _TEXT_COLUMNS)
    + " FROM s1 FULL OUTER JOIN s2 USING (sig_project, sig_region, sig_id)",
)
def merge_nonblank(spark, sf):
    merged = R.merge_nonblank(matched(spark, sf), _TEXT_COLUMNS, owned=("work_id",))
    return merged.drop("status")


_UPDATES = " + ".join(
    f"CASE WHEN trim(s2.{c}) IN {_BLANK} THEN 0 ELSE 1 END" for c in _TEXT_COLUMNS
)


@query(
    "merge_cell_counters",
    t.SQL_WORKS
    + f""" SELECT CAST(sum(u) AS BIGINT) AS cells_updated,
             CAST(sum(25 - u) AS BIGINT) AS cells_preserved
           FROM (SELECT {_UPDATES} AS u FROM s1 JOIN s2 USING (sig_project, sig_region, sig_id))""",
)
def merge_cell_counters(spark, sf):
    return R.merge_counters(matched(spark, sf), MERGE_COLUMNS)


@query(
    "merge_append_new",
    t.SQL_WORKS
    + """ SELECT work_id, region, project_key, progress, CAST(NULL AS VARCHAR) AS added
          FROM s1
          UNION ALL
          SELECT work_id, region, project_key, CAST(NULL AS VARCHAR) AS progress, 'yes' AS added
          FROM s2 WHERE NOT EXISTS (SELECT 1 FROM s1 WHERE s1.sig_project = s2.sig_project
            AND s1.sig_region = s2.sig_region AND s1.sig_id = s2.sig_id)""",
)
def merge_append_new(spark, sf):
    old, new = snapshots(spark, sf)
    columns = ["work_id", "region", "project_key"]
    known = old.select(*columns, *R.SIGNATURE, "progress")
    return R.append_new(known, new, columns, added=F.lit("yes")).drop(*R.SIGNATURE)


@query(
    "reconcile_history",
    t.SQL_WORKS
    + """ SELECT sig_project, sig_region, sig_id, '2024-05-01 12:00' AS run, progress AS pct_text, pct
          FROM s1
          UNION ALL
          SELECT sig_project, sig_region, sig_id, '2024-06-01 09:30' AS run, progress AS pct_text, pct
          FROM s2""",
)
def reconcile_history(spark, sf):
    old, new = snapshots(spark, sf)
    history = R.observations(old, F.lit(RUN_1)).unionByName(R.observations(new, F.lit(RUN_2)))
    return history.select(
        *R.SIGNATURE, F.date_format("run_ts", "yyyy-MM-dd HH:mm").alias("run"), "pct_text", "pct"
    )


@query(
    "dedupe_keep_first",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, l_extendedprice
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_suppkey, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax,
              l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem)
    WHERE rn = 1""",
)
def dedupe_keep_first(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    first = keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_partkey"])
    return first.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice"
    )


@query(
    "kpi_summary",
    t.SQL_MATCHED
    + """ SELECT works, new, finished, vanished, amount,
            CASE WHEN amount <> 0 THEN printf('%.1f', amount / 1e6) ELSE 'N/D' END AS amount_millions
          FROM (SELECT CAST(count(*) AS BIGINT) AS works,
              CAST(count(*) FILTER (label = 'Obra Nueva') AS BIGINT) AS new,
              CAST(count(*) FILTER (label IN ('Obra Conclusa', 'Obra Conclusa (probable)')) AS BIGINT)
                AS finished,
              CAST(count(*) FILTER (label = 'Obra Desaparecida') AS BIGINT) AS vanished,
              round(sum(try_cast(amount_total AS DOUBLE)), 2) AS amount
            FROM labelled)""",
)
def kpi_summary(spark, sf):
    return views.kpis(labelled(spark, sf))


@query(
    "filter_label_or_delta",
    t.SQL_MATCHED
    + """ SELECT sig_id, label FROM labelled
          WHERE label IN ('Obra Nueva', 'Obra Conclusa') OR regexp_matches(label, '^[+-]?[0-9]')""",
)
def filter_label_or_delta(spark, sf):
    chosen = ["Obra Nueva", "Obra Conclusa"]
    return views.filter_labels(labelled(spark, sf), chosen).select("sig_id", "label")


def both_runs(spark: SparkSession, sf: str) -> State:
    state = State(spark, new_folder(spark, "state"))
    for run_ts, status in ((RUN_1, t.OLD), (RUN_2, t.NEW)):
        ingest_run(state, t.works_snapshot(spark, sf, status), run_ts)
    return state


@query(
    "ingest_runs_into_state",
    t.SQL_MATCHED + " SELECT sig_project, sig_region, sig_id, status, label FROM labelled",
)
def ingest_runs_into_state(spark, sf):
    """Both snapshots folded into a state on disk, one run after the other, then labelled."""
    state = both_runs(spark, sf)
    return state.labelled().select(*R.SIGNATURE, "status", "label")


@query(
    "tag_edits_into_state",
    t.SQL_WORKS
    + """, edited AS (
            SELECT *, CASE right(work_id, 1) WHEN '1' THEN 'Non interessa' WHEN '4' THEN 'Da caricare' ELSE '' END AS tag
            FROM (SELECT coalesce(s1.work_id, s2.work_id) AS work_id, sig_project || '|' || sig_region AS pair
                  FROM s1 FULL OUTER JOIN s2 USING (sig_project, sig_region, sig_id))),
          deny AS (
            SELECT pair FROM edited WHERE tag = 'Non interessa'
            EXCEPT SELECT pair FROM edited WHERE tag = 'Da caricare')
          SELECT work_id, tag, deny.pair IS NOT NULL AS listed FROM edited LEFT JOIN deny USING (pair)""",
)
def tag_edits_into_state(spark, sf):
    """Two runs, then tags stored by the last digit of the id; who is on the deny-list afterwards."""
    state = both_runs(spark, sf)
    digit = F.substring("work_id", -1, 1)
    tags = F.when(digit == "1", F.lit("Non interessa")).when(digit == "4", F.lit("Da caricare"))
    edits = state.entities().select("work_id", F.lit(1).alias("seq"), tags.alias("new_tag"))
    save_tags(state, edits.where(F.col("new_tag").isNotNull()), date(2024, 6, 2))
    listed = D.with_denied(state.entities(), state.entries())
    return listed.select("work_id", "tag", F.col("denied").alias("listed"))


@query(
    "stream_into_state",
    t.SQL_MATCHED + " SELECT sig_project, sig_region, sig_id, status, label FROM labelled",
)
def stream_into_state_query(spark, sf):
    """Both snapshots landed as files, the newer first and one file a batch, folded in by the stream."""
    landed, state = new_folder(spark, "landed"), State(spark, new_folder(spark, "state"))
    for run_ts, status in ((RUN_2, t.NEW), (RUN_1, t.OLD)):
        rows = t.works_snapshot(spark, sf, status).withColumn("run_ts", F.lit(run_ts))
        # A dump lands as a few files, however large it is: a file is a batch here.
        dump = rows.coalesce(LANDED_FILES).write.mode("append").option("compression", "zstd")
        dump.option("parquet.block.size", ROW_GROUP).parquet(landed)
    stream_into_state(state, landed, rows.schema, files_per_batch=1)
    return state.labelled().select(*R.SIGNATURE, "status", "label")


@query(
    "stream_empty_poll",
    t.SQL_MATCHED + " SELECT label, count(*) AS works, CAST(2 AS BIGINT) AS runs, CAST(2 AS BIGINT) AS commits FROM labelled GROUP BY label",
)
def stream_empty_poll(spark, sf):
    """Polls that bring nothing: before the first snapshot, between two and after both, without a new file and
    with one that holds no row. Labels are as without them, and so are runs and commits."""
    landed, state = new_folder(spark, "landed"), State(spark, new_folder(spark, "state"))
    for run_ts, status in ((RUN_1, t.OLD), (RUN_2, t.NEW)):
        rows = t.works_snapshot(spark, sf, status).withColumn("run_ts", F.lit(run_ts))
        for landing in (rows.limit(0), rows):
            landing.write.mode("append").option("compression", "zstd").parquet(landed)
            for _ in range(2):
                stream_into_state(state, landed, rows.schema)
    counted = state.labelled().groupBy("label").agg(F.count("*").alias("works"))
    return counted.select("label", "works", *[F.lit(n).cast("long").alias(c) for c, n in (("runs", state.runs().count()), ("commits", state.commits().count()))])


@query(
    "rebuild_entities",
    t.SQL_WORKS
    + " SELECT sig_project, sig_region, sig_id, coalesce(s1.work_id, s2.work_id) AS work_id, "
    + ", ".join(_sql_merged(c) for c in _TEXT_COLUMNS)
    + " FROM s1 FULL OUTER JOIN s2 USING (sig_project, sig_region, sig_id)",
)
def rebuild_entities_query(spark, sf):
    """The same entities as folding run after run, from the log in one aggregation."""
    old, new = snapshots(spark, sf)
    log = old.withColumn("run_ts", F.lit(RUN_1)).unionByName(new.withColumn("run_ts", F.lit(RUN_2)))
    return rebuild_entities(log).select(*R.SIGNATURE, "work_id", *_TEXT_COLUMNS)
