"""Rows on their way into the state: checked, and with fields nobody knows yet."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrack.functions.text import strip
from snaptrack.operators import quarantine as Q
from snaptrack.operators import reconcile as R
from snaptrack.plans import tables as t
from snaptrack.plans.queries_runs import sql_labels
from snaptrack.plans.queries_works import RUN_1, RUN_2
from snaptrack.plans.registry import query
from snaptrack.plans.state import State, ingest_checked, refresh
from snaptrack.schemas import CORRUPT
from snaptrack.sources import landing
from snaptrack.sources.shared import new_folder


@query(
    "quarantine_rows",
    f"""
    WITH landed AS (
      SELECT CASE WHEN l_linenumber = 7 THEN '  ' ELSE ' ' || l_orderkey END AS work_id,
        CAST(l_linenumber AS INTEGER) AS line, CAST(l_suppkey AS VARCHAR) AS supplier,
        CASE WHEN l_returnflag = 'R' AND l_quantity < 10 THEN 'unknown' WHEN l_returnflag = 'A' AND l_quantity < 10 THEN ''
          ELSE {t.sql_dotted('CAST(round(l_extendedprice * 100) AS BIGINT)', ',')} END AS amount,
        l_tax = 0 AS cut_off
      FROM lineitem),
    judged AS (
      SELECT *, concat_ws(', ', CASE WHEN cut_off THEN 'unreadable' END, CASE WHEN trim(work_id) = '' THEN 'blank key' END,
        CASE WHEN amount = 'unknown' THEN 'bad amount' END) AS found
      FROM landed),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY found = '', trim(work_id) ORDER BY line, supplier, amount) AS place FROM judged)
    SELECT work_id, line, supplier, amount, found = '' AND place = 1 AS kept,
      CASE WHEN found = '' AND place > 1 THEN 'duplicate key' ELSE found END AS reasons
    FROM ranked""",
)
def quarantine_rows(spark, sf):
    """Every line as one landed row: kept, or set aside with its reasons."""
    few = F.col("l_quantity") < 10
    amount = F.when((F.col("l_returnflag") == "R") & few, "unknown").when((F.col("l_returnflag") == "A") & few, "")
    landed = t.table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, F.lit("  ")).otherwise(F.concat(F.lit(" "), t.text("l_orderkey"))).alias("work_id"),
        F.col("l_linenumber").cast("int").alias("line"),
        t.text("l_suppkey").alias("supplier"),
        amount.otherwise(t.dotted(t.cents("l_extendedprice"), ",")).alias("amount"),
        F.when(F.col("l_tax") == 0, F.lit("{")).alias(CORRUPT),
    )
    rules = [Q.unreadable(), Q.blank_key("work_id"), Q.bad_amount("amount")]
    found = Q.sort_out(landed, rules, strip(F.col("work_id")), ["line", "supplier"])
    return found.select(
        "work_id", "line", "supplier", "amount", (F.size(Q.REASONS) == 0).alias("kept"),
        F.array_join(Q.REASONS, ", ").alias("reasons"),
    )


@query(
    "quarantine_into_state",
    f"""{t.SQL_WORKS},
    raw_history AS (
      SELECT sig_project, sig_region, sig_id, TIMESTAMP '{RUN_1}' AS run_ts, progress AS pct_text, pct FROM s1
      UNION ALL SELECT sig_project, sig_region, sig_id, TIMESTAMP '{RUN_2}', progress, pct FROM s2 WHERE right(work_id, 1) <> '7'),
    {sql_labels(*R.SIGNATURE)}""",
)
def quarantine_into_state(spark, sf):
    """Two checked runs, the second with keys lost from works ending in 7, and a third that has too many of
    those and is stopped."""
    state = State(spark, new_folder(spark, "state"))
    rules = [Q.blank_key("work_id", limit=0.5), Q.bad_amount("amount_main", limit=0.0)]
    ingest_checked(state, t.works_snapshot(spark, sf, t.OLD), RUN_1, rules)
    newer = t.works_snapshot(spark, sf, t.NEW)
    lost = F.when(F.col("work_id").endswith("7"), F.lit(" ")).otherwise(F.col("work_id"))
    ingest_checked(state, newer.withColumn("work_id", lost), RUN_2, rules)
    try:
        ingest_checked(state, newer.withColumn("work_id", F.lit("")), RUN_2 + timedelta(days=1), rules)
    except Q.LimitExceeded:
        pass
    return state.labelled().select(*R.SIGNATURE, "status", "last_known", "pct_now", "pct_before", "label")


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
LEAST = 200_000.0


def _open_works(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed as JSON lines with fields that no column takes: a number for urgent ones, an object for
    pending ones, and one whose kind changes from row to row for urgent ones."""
    key, urgent = F.col("o_orderkey"), F.col("o_orderpriority") == PRIORITIES[0]
    record = F.to_json(F.struct(
        t.text(key).alias("id"), F.col("o_orderpriority").alias("_regione"),
        t.dotted(t.cents("o_totalprice"), ",").alias("importo_lav_totale"),
        F.when(urgent, F.col("o_custkey")).alias("lotto"),
        F.when(F.col("o_orderstatus") == "P", F.struct((key % 7).alias("codice"), F.col("o_orderstatus").alias("nome"))).alias("ente"),
    ))
    note = F.when(key % 2 == 0, F.lit('{"nota": "pari", ')).otherwise(F.lit('{"nota": 1, '))
    line = F.when(urgent, F.concat(note, F.substring(record, 2, 1_000_000))).otherwise(record)
    folder = new_folder(spark, "landed-open")
    t.table(spark, sf, "orders").select(line.alias("value")).write.text(folder)
    return landing.scan_works_open(spark, folder, regions=PRIORITIES)


@query(
    "unknown_fields_drift",
    """
    WITH urgent AS (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT o_orderpriority AS region, 'lotto' AS field, 'BIGINT' AS kind, CAST(count(*) AS BIGINT) AS rows FROM urgent GROUP BY ALL
    UNION ALL
    SELECT o_orderpriority, 'nota', CASE WHEN min(o_orderkey % 2) < max(o_orderkey % 2) THEN 'VARIANT'
      WHEN min(o_orderkey % 2) = 0 THEN 'STRING' ELSE 'BIGINT' END, count(*) FROM urgent GROUP BY o_orderpriority
    UNION ALL
    SELECT o_orderpriority, 'ente', 'OBJECT<codice: BIGINT, nome: STRING>', count(*) FROM orders
    WHERE o_orderstatus = 'P' GROUP BY o_orderpriority""",
)
def unknown_fields_drift(spark, sf):
    """Which fields came that no column takes, by region, with their kinds."""
    return landing.drift(_open_works(spark, sf)).withColumnRenamed("_regione", "region")


@query(
    "unknown_fields_in_state",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS work_id, o_orderpriority AS region,
      CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END AS lotto,
      CASE WHEN o_orderpriority = '1-URGENT' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'pari' ELSE '1' END END AS nota,
      CASE WHEN o_orderstatus = 'P' THEN o_orderkey % 7 END AS codice
    FROM orders WHERE (o_orderpriority = '1-URGENT' OR o_orderstatus = 'P') AND o_totalprice >= {LEAST}""",
)
def unknown_fields_in_state(spark, sf):
    """A run with such fields, projected from the state afterwards."""
    state = State(spark, new_folder(spark, "state"))
    refresh(state, _open_works(spark, sf), RUN_1, regions=PRIORITIES, minimum=LEAST)
    fields = {"lotto": "bigint", "nota": "string", "codice": "bigint"}
    paths = {"codice": "$.ente.codice"}
    return state.unknown(RUN_1).select(
        "work_id", "region", *[F.try_variant_get("fields", paths.get(c, f"$.{c}"), kind).alias(c) for c, kind in fields.items()]
    )
