"""Raw side: landed files, projection, scalar cleaning, scope filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from snaptrack import schemas
from snaptrack.functions import geo, numbers, segments, text, times
from snaptrack.operators import shape
from snaptrack.operators.reconcile import with_signature
from snaptrack.plans import tables as t
from snaptrack.plans.registry import query
from snaptrack.sources import documents, landing, snapshots
from snaptrack.sources.runs import run_record
from snaptrack.sources.shared import new_folder

SCOPE = ("NATION_1", "NATION_3", "NATION_5", "NATION_7", "NATION_11", "NATION_13")
MINIMUM = 200_000.0


def _raw_works(spark, sf):
    """Lines as landed raw works, each with its own nested list of segments."""
    flag = F.col("l_returnflag")
    first = F.struct(
        F.concat(F.lit("R"), t.text("l_suppkey")).alias("CODICE_STRADA"),
        t.text("l_linenumber").alias("DALKM"),
        t.text(F.col("l_quantity").cast("int")).alias("ALKM"),
    )
    second = F.struct(
        F.concat(F.lit("S"), t.text("l_partkey")).alias("CODICE_STRADA"),
        F.when(flag == "A", t.text("l_linenumber")).alias("DALKM"),
        F.lit("9").alias("ALKM"),
    )
    return t.line_table(spark, sf).select(
        t.text("l_orderkey").alias("id"),
        F.concat(F.lit(" C"), t.text("o_custkey"), F.lit(" ")).alias("cup"),
        F.concat(F.lit("\t"), "o_orderpriority", F.lit('\r\n"'), "l_linestatus", F.lit('", ')).alias(
            "descrizione"
        ),
        F.col("c_mktsegment").alias("tipo_lavoro"),
        F.when(flag == "N", F.lit(None)).otherwise(F.concat(F.lit("Supplier "), t.text("l_suppkey"))).alias(
            "impresa"
        ),
        F.concat(t.text(t.cents("l_extendedprice")), F.lit("E-2")).alias("importo_lav_principali"),
        t.dotted(t.cents("o_totalprice"), ",").alias("importo_lav_totale"),
        F.date_format("l_shipdate", "dd-MM-yyyy").alias("data_consegna_impresa"),
        t.progress_text().alias("avanzamento_lavori"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ultimazione"),
        F.when(flag != "R", F.array(first, second)).alias("strade_list"),
        F.when(flag != "N", F.col("l_quantity")).alias("lat"),
        F.col("l_linenumber").cast("double").alias("lng"),
        F.col("n_name").alias("_regione"),
        F.concat(F.lit("R"), t.text("l_suppkey")).alias("_strada_cod"),
        F.concat(F.lit("Road "), t.text("l_suppkey")).alias("_strada_nome"),
    )


_SQL_SEGMENTS = """
      CASE l_returnflag WHEN 'R' THEN '' ELSE 'R' || l_suppkey || ' ' || l_linenumber || '–'
        || CAST(l_quantity AS INTEGER) || '; S' || l_partkey || ' '
        || CASE l_returnflag WHEN 'A' THEN CAST(l_linenumber AS VARCHAR) ELSE '' END || '–9' END"""

_SQL_PROJECTED = f"""
  WITH {t._LINES}
  SELECT CAST(l_orderkey AS VARCHAR) AS work_id, n_name AS region, 'R' || l_suppkey AS road_code,
    'Road ' || l_suppkey AS road_name, 'C' || o_custkey AS project_key,
    o_orderpriority || ' "' || l_linestatus || '",' AS description, c_mktsegment AS work_type,
    CASE l_returnflag WHEN 'N' THEN '' ELSE 'Supplier ' || l_suppkey END AS contractor,
    CAST(round(l_extendedprice * 100) AS BIGINT) / 100 AS amount_main,
    CAST(round(o_totalprice * 100) AS BIGINT) / 100 AS amount_total,
    strftime(l_shipdate, '%d-%m-%Y') AS delivered_on,
    CASE WHEN l_discount = 0 AND l_tax = 0 THEN '' ELSE {t.sql_dotted(t._X, ',')} END AS progress,
    strftime(o_orderdate, '%Y-%m-%d') AS due_on,
    CASE l_returnflag WHEN 'R' THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS km_from,
    CASE l_returnflag WHEN 'R' THEN '' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS km_to,
    {_SQL_SEGMENTS} AS segments,
    CASE l_returnflag WHEN 'N' THEN '' ELSE CAST(l_quantity AS INTEGER) || '.000000, '
      || l_linenumber || '.000000' END AS coordinate,
    {", ".join(f"'' AS {c}" for c in schemas.RECORD_COLUMNS)}
  FROM lines"""


@query("project_snapshot", _SQL_PROJECTED)
def project_snapshot(spark, sf):
    return shape.project_snapshot(_raw_works(spark, sf))


@query("scan_nested_json", _SQL_PROJECTED)
def scan_nested_json(spark, sf):
    """Lands the raw works as JSON lines, scans them back and projects them."""
    folder = new_folder(spark, "landing")
    # A part of the dump is one compressed file; what names its fields in every line shrinks most.
    _raw_works(spark, sf).write.option("compression", "gzip").json(folder)
    return shape.project_snapshot(landing.scan_works(spark, folder))


_SQL_ROUNDTRIP = f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS work_id, o_orderpriority AS region,
    '"' || o_orderstatus || '", a' || chr(10) || 'b' AS description, ' c ' AS contractor,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS progress,
    {t.sql_dotted('CAST(round(o_totalprice * 100) AS BIGINT)', '.')} AS amount_total
  FROM orders"""


def _plain_snapshot(spark, sf):
    status = F.col("o_orderstatus")
    rows = t.table(spark, sf, "orders").select(
        t.text("o_orderkey").alias("work_id"),
        F.col("o_orderpriority").alias("region"),
        F.concat(F.lit('"'), status, F.lit('", a\nb')).alias("description"),
        F.lit(" c ").alias("contractor"),
        F.when(status != "P", status).alias("progress"),
        t.dotted(t.cents("o_totalprice"), ".").alias("amount_total"),
    )
    return shape.align_schema(rows, schemas.SNAPSHOT_COLUMNS).select(*schemas.SNAPSHOT_COLUMNS)


_ROUNDTRIP = ["work_id", "region", "description", "contractor", "progress", "amount_total"]


@query("snapshot_roundtrip", _SQL_ROUNDTRIP)
def snapshot_roundtrip(spark, sf):
    """CSV out and back in: quotes, commas, line breaks and blanks survive."""
    folder = new_folder(spark, "snapshot-csv")
    snapshots.write_csv(_plain_snapshot(spark, sf), folder)
    return snapshots.scan_csv(spark, folder).select(*_ROUNDTRIP)


@query(
    "snapshot_runs_table",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS work_id, strftime(o_orderdate, '%Y-%m-%d') AS run_day
    FROM orders WHERE date_trunc('year', o_orderdate)
      = (SELECT max(date_trunc('year', o_orderdate)) FROM orders)""",
)
def snapshot_runs_table(spark, sf):
    """Runs as partitions, one per order year; reading the newest prunes all others."""
    folder = new_folder(spark, "snapshot-runs")
    year = F.date_trunc("year", "o_orderdate")
    orders = t.table(spark, sf, "orders")
    # One writer task per run would put a heavy run into one task: spread by row instead.
    snapshots.write_run(
        orders.select(
            t.text("o_orderkey").alias("work_id"), F.to_date("o_orderdate").alias("day"),
            F.to_date(year).alias("run_date"), F.date_format(year, times.FILE_RUN).alias("run_ts"),
        ),
        folder,
    )
    runs = spark.read.parquet(folder)
    newest = orders.agg(F.to_date(F.date_trunc("year", F.max("o_orderdate"))).alias("d"))
    return runs.where(F.col("run_date") == newest.scalar()).select(
        "work_id", F.date_format("day", "yyyy-MM-dd").alias("run_day")
    )


@query(
    "validate_snapshot",
    """
    SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT)
      AS blank_keys, count(*) > 0 AS usable FROM orders""",
)
def validate_snapshot(spark, sf):
    key = F.when(F.col("o_orderstatus") == "P", F.lit("  ")).otherwise(t.text("o_orderkey"))
    snapshot = t.table(spark, sf, "orders").select(key.alias("work_id"))
    return snapshots.snapshot_health(snapshots.require_usable(snapshot, "work_id"), "work_id")


@query(
    "attach_dimension",
    """
    SELECT c_custkey, r_name AS region, n_nationkey AS road_code, n_name AS road_name
    FROM customer LEFT JOIN (nation JOIN region ON r_regionkey = n_regionkey)
      ON n_nationkey = c_nationkey""",
)
def attach_dimension(spark, sf):
    region = t.table(spark, sf, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")
    )
    roads = t.table(spark, sf, "nation").join(region, "n_regionkey").select(
        F.col("n_nationkey").alias("road_code"), F.col("n_name").alias("road_name"), "region"
    )
    works = t.table(spark, sf, "customer").withColumnRenamed("c_nationkey", "road_code")
    return shape.attach_roads(works, roads, ["road_code"]).select(
        "c_custkey", "region", "road_code", "road_name"
    )


@query(
    "attach_marker",
    """
    WITH m AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
        l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_discount DESC) AS rn
      FROM lineitem)
    SELECT CAST(o_orderkey AS VARCHAR) AS id, l_quantity AS lat, l_discount AS lng,
      CASE WHEN rn IS NULL THEN ''
        ELSE printf('%.6f', l_quantity) || ', ' || printf('%.6f', l_discount) END AS coordinate
    FROM orders LEFT JOIN m ON l_orderkey = o_orderkey AND rn = 1""",
)
def attach_marker(spark, sf):
    markers = t.table(spark, sf, "lineitem").select(
        t.text("l_orderkey").alias("id"), F.col("l_quantity").alias("lat"),
        F.col("l_discount").alias("lng"), "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey",
    )
    works = t.table(spark, sf, "orders").select(t.text("o_orderkey").alias("id"))
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "lat", "lng"]
    return shape.attach_marker(works, markers, order).withColumn(
        "coordinate", geo.format_coordinate(F.col("lat"), F.col("lng"))
    )


def _amount_spelling():
    """Three spellings by order status: thousands dots, exponent, and the ambiguous plain dot."""
    status = F.col("o_orderstatus")
    european = F.translate(
        F.call_function("format_number", F.col("o_totalprice"), F.lit("#,##0.00")), ",.", ".,"
    )
    return (
        F.when(status == "F", european)
        .when(status == "O", F.concat(t.text(t.cents("o_totalprice")), F.lit("E-2")))
        .otherwise(t.dotted(t.cents("o_totalprice"), "."))
    )


_SQL_AMOUNT = """CASE WHEN o_orderstatus = 'P' THEN CAST(CAST(round(o_totalprice * 100) AS BIGINT)
  AS DOUBLE) ELSE CAST(round(o_totalprice * 100) AS BIGINT) / 100 END"""


@query(
    "parse_amount",
    f"""SELECT o_orderkey, {_SQL_AMOUNT} AS amount,
      CAST(round(o_totalprice * 100) AS BIGINT) / 100 AS amount_strict,
      o_orderstatus = 'P' AS ambiguous FROM orders""",
)
def parse_amount(spark, sf):
    spelled = t.table(spark, sf, "orders").select("o_orderkey", _amount_spelling().alias("a"))
    a = F.col("a")
    return spelled.select(
        "o_orderkey", numbers.parse_amount(a).alias("amount"),
        numbers.parse_amount_strict(a).alias("amount_strict"),
        numbers.has_ambiguous_dot(a).alias("ambiguous"),
    )


@query(
    "filter_min_amount",
    f"SELECT o_orderkey FROM orders WHERE {_SQL_AMOUNT} >= {MINIMUM}",
)
def filter_min_amount(spark, sf):
    spelled = t.table(spark, sf, "orders").select("o_orderkey", _amount_spelling().alias("a"))
    return shape.filter_min_amount(spelled, "a", MINIMUM).select("o_orderkey")


@query(
    "run_metadata",
    f"""SELECT '2024-07-01 09:00:15' AS run, strftime(max(o_orderdate), '%Y-%m-%d') AS updated_at,
      'NATION_1, NATION_3' AS regions, CAST(count(*) AS BIGINT) AS total_rows,
      CAST(count(*) FILTER ({_SQL_AMOUNT} >= {MINIMUM}) AS BIGINT) AS kept_rows FROM orders""",
)
def run_metadata(spark, sf):
    raw = t.table(spark, sf, "orders").select("o_orderdate", _amount_spelling().alias("a"))
    kept = F.coalesce(numbers.parse_amount(F.col("a")), F.lit(0.0)) >= MINIMUM
    record = run_record(raw, kept, datetime(2024, 7, 1, 9, 0, 15), "o_orderdate", SCOPE[:2])
    return record.select(
        F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("run"),
        F.date_format("updated_at", "yyyy-MM-dd").alias("updated_at"),
        "regions", "total_rows", "kept_rows",
    )


@query(
    "filter_scope",
    "SELECT o_orderkey, n_name FROM orders JOIN customer ON c_custkey = o_custkey "
    f"JOIN nation ON n_nationkey = c_nationkey WHERE n_name IN {SCOPE}",
)
def filter_scope(spark, sf):
    rows = t.orders_with_nation(spark, sf).select("o_orderkey", "n_name")
    return shape.filter_scope(rows, "n_name", SCOPE)


@query(
    "align_schema",
    """
    SELECT o_orderkey, o_orderstatus, '' AS official_name, '' AS coordinate,
      o_orderpriority AS "Avanz_01-01-2024_0000" FROM orders""",
)
def align_schema(spark, sf):
    rows = t.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("Avanz_01-01-2024_0000")
    )
    return shape.align_schema(rows, ["o_orderstatus", "official_name", "coordinate"])


@query(
    "union_partitions",
    """
    SELECT 'customer' AS part, c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT 'supplier', s_name, s_nationkey FROM supplier
    UNION ALL SELECT 'nation', n_name, n_nationkey FROM nation""",
)
def union_partitions(spark, sf):
    sources = {"customer": "c_", "supplier": "s_", "nation": "n_"}
    return shape.union_regions(
        [
            t.table(spark, sf, name).select(
                F.lit(name).alias("part"), F.col(f"{p}name").alias("name"),
                F.col(f"{p}nationkey").alias("nation"),
            )
            for name, p in sources.items()
        ]
    )


@query(
    "normalise_blanks",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN NULL WHEN 'view' THEN NULL
      WHEN 'error' THEN NULL WHEN 'signup' THEN 'NaN' ELSE CAST(value AS VARCHAR) END AS value
    FROM events""",
)
def normalise_blanks(spark, sf):
    kind = F.col("event_type")
    raw = (
        F.when(kind == "click", F.lit(" None "))
        .when(kind == "view", F.lit("nan "))
        .when(kind == "error", F.lit("0.000000, 0.000000"))
        .when(kind == "signup", F.lit("NaN"))
        .otherwise(t.text("value"))
    )
    clean = text.blank_to_null(raw, "0.000000, 0.000000")
    return t.table(spark, sf, "events").select("event_id", clean.alias("value"))


_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


@query(
    "clean_text",
    f"""
    SELECT doc_id, CAST(length(c) AS INTEGER) AS chars, md5(c) AS digest FROM (
      SELECT doc_id, trim(regexp_replace(text, '[\\r\\n\\t]+', ' ', 'g'), {_WS}) AS c FROM documents)""",
)
def clean_text(spark, sf):
    cleaned = t.table(spark, sf, "documents").select(
        "doc_id", text.clean_text(F.col("text")).alias("c")
    )
    return cleaned.select("doc_id", F.length("c").alias("chars"), F.md5("c").alias("digest"))


@query(
    "normalise_key",
    """
    SELECT c_custkey, 'C' || c_custkey AS sig_project, lower(n_name) AS sig_region,
      CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS sig_id
    FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def normalise_key(spark, sf):
    nation = t.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = t.table(spark, sf, "customer").join(nation, "c_nationkey").select(
        "c_custkey",
        F.concat(F.lit(" C"), t.text("c_custkey"), F.lit(" \t")).alias("project_key"),
        F.concat(F.lit(" "), "n_name", F.lit("\n")).alias("region"),
        F.when(F.col("c_acctbal") >= 0, t.text("c_custkey")).alias("work_id"),
    )
    return with_signature(rows).select("c_custkey", "sig_project", "sig_region", "sig_id")


@query(
    "format_delta",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN l_returnflag = 'N' THEN '' WHEN d > 0 THEN '+' || printf('%.1f', d) || '%'
        WHEN d < 0 THEN printf('%.1f', d) || '%' ELSE '0%' END AS label
    FROM (SELECT *, l_extendedprice / 1000 - l_quantity AS d FROM lineitem)""",
)
def format_delta(spark, sf):
    before = F.when(F.col("l_returnflag") != "N", F.col("l_quantity"))
    label = numbers.format_delta(F.col("l_extendedprice") / 1000, before)
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", label.alias("label")
    )


@query(
    "format_coordinate",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' OR (c_acctbal = 0 AND c_custkey = 0) THEN ''
      ELSE printf('%.6f', c_acctbal / 7) || ', ' || printf('%.6f', c_custkey / 3) END AS coordinate
    FROM customer""",
)
def format_coordinate(spark, sf):
    lat = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal") / 7)
    coordinate = geo.format_coordinate(lat, F.col("c_custkey") / 3)
    return t.table(spark, sf, "customer").select("c_custkey", coordinate.alias("coordinate"))


@query(
    "coordinate_link",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
      THEN 'https://www.google.com/maps?q=' || c_nationkey || '.5,' || c_custkey ELSE '' END AS link
    FROM customer""",
)
def coordinate_link(spark, sf):
    lat = F.concat(t.text("c_nationkey"), F.lit(".5"))
    lng, segment = t.text("c_custkey"), F.col("c_mktsegment")
    coordinate = (
        F.when(segment == "AUTOMOBILE", F.concat(lat, F.lit(", "), lng))
        .when(segment == "BUILDING", F.concat(lat, F.lit(" ; "), lng))
        .when(segment == "FURNITURE", F.concat(lat, F.lit(","), lng, F.lit(", 9")))
        .when(segment == "HOUSEHOLD", lat)
        .otherwise(F.concat(lat, F.lit(", x"), lng))
    )
    return t.table(spark, sf, "customer").select(
        "c_custkey", geo.coordinate_link(coordinate).alias("link")
    )


@query(
    "first_token",
    "SELECT p_partkey, trim(p_type) AS token FROM part",
)
def first_token(spark, sf):
    joined = F.when(
        F.col("p_size") > 25, F.concat(F.lit(" "), "p_type", F.lit("; "), "p_name", F.lit(", x"))
    ).otherwise(F.concat("p_type", F.lit(" , "), "p_brand"))
    return t.table(spark, sf, "part").select("p_partkey", text.first_token(joined).alias("token"))


@query(
    "parse_run_id",
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL
      WHEN 'click' THEN strftime(date_trunc('day', ts), '%Y%m%d_%H%M%S')
      WHEN 'view' THEN strftime(date_trunc('day', ts), '%Y%m%d_%H%M%S')
      WHEN 'signup' THEN strftime(date_trunc('second', ts), '%Y%m%d_%H%M%S')
      ELSE strftime(date_trunc('minute', ts), '%Y%m%d_%H%M%S') END AS run,
      'Avanz_' || strftime(ts, '%d-%m-%Y_%H%M') AS run_name
    FROM events""",
)
def parse_run_id(spark, sf):
    kind, ts = F.col("event_type"), F.col("ts")
    run = (
        F.when(kind == "signup", times.parse_run_file(
            F.concat(F.lit("works_"), times.format_run_file(ts), F.lit(".csv"))))
        .when(kind == "click", times.parse_run_id(F.date_format(ts, "'Avanz_'dd-MM-yyyy")))
        .when(kind == "view", times.parse_run_id(F.date_format(ts, "yyyy-MM-dd")))
        .when(kind == "error", times.parse_run_id(F.lit("Avanz_x")))
        .otherwise(times.parse_run_id(times.format_run_id(ts)))
    )
    return t.table(spark, sf, "events").select(
        "event_id", times.format_run_file(run).alias("run"), times.format_run_id(ts).alias("run_name")
    )


@query(
    "validate_key_format",
    """
    SELECT c_custkey, c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AS valid FROM customer""",
)
def validate_key_format(spark, sf):
    from snaptrack.constants import PROJECT_KEY_PATTERN

    number = F.lpad(t.text("c_custkey"), 11, "0")
    start = F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), F.lit("F12C"))
    key = F.concat(start.when(F.col("c_mktsegment") == "MACHINERY", F.lit("f12C")).otherwise(F.lit("F1C")), number)
    return t.table(spark, sf, "customer").select("c_custkey", key.rlike(PROJECT_KEY_PATTERN).alias("valid"))


@query(
    "segments_flatten",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {_SQL_SEGMENTS} AS segments,
      CASE l_returnflag WHEN 'R' THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS km_from,
      CASE l_returnflag WHEN 'R' THEN '' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS km_to
    FROM lineitem""",
)
def segments_flatten(spark, sf):
    flag = F.col("l_returnflag")
    first = F.struct(
        F.concat(F.lit("R"), t.text("l_suppkey")).alias("CODICE_STRADA"),
        t.text("l_linenumber").alias("DALKM"), t.text(F.col("l_quantity").cast("int")).alias("ALKM"),
    )
    second = F.struct(
        F.concat(F.lit("S"), t.text("l_partkey")).alias("CODICE_STRADA"),
        F.when(flag == "A", t.text("l_linenumber")).alias("DALKM"), F.lit("9").alias("ALKM"),
    )
    s = F.when(flag != "R", F.array(first, second))
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        segments.segments_text(s).alias("segments"),
        segments.first_of(s, "DALKM").alias("km_from"), segments.first_of(s, "ALKM").alias("km_to"),
    )


@query(
    "scan_csv_by_name",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS work_id, o_orderpriority AS region, 'C' || o_custkey AS project_key,
      '' AS road_code, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS progress FROM orders""",
)
def scan_csv_by_name(spark, sf):
    """A foreign file: other order, the source's own headers, columns missing and too many."""
    folder = new_folder(spark, "foreign-csv")
    status = F.col("o_orderstatus")
    rows = t.table(spark, sf, "orders").select(
        F.lit("x").alias("Unknown"),
        F.when(status != "P", status).alias("Avanzamento_Lavori"),
        F.concat(F.lit("C"), t.text("o_custkey")).alias("Cup"),
        F.col("o_orderpriority").alias("Regione"),
        t.text("o_orderkey").alias("Id_ANAS"),
    )
    snapshots.write_csv(rows, folder)
    return snapshots.scan_csv(spark, folder).select("work_id", "region", "project_key", "road_code", "progress")


@query(
    "scan_raw_as_landed",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS work_id, 'Puglia' AS region,
      CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(round(o_totalprice * 100) AS BIGINT) / 100 END AS amount_total,
      CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE (o_custkey % 90) || '.500000, 7.250000' END AS coordinate,
      FALSE AS broken FROM orders
    UNION ALL SELECT '' AS work_id, 'Puglia' AS region, NULL AS amount_total, '' AS coordinate, TRUE AS broken
      FROM orders WHERE o_orderstatus = 'P'""",
)
def scan_raw_as_landed(spark, sf):
    """Files named by region: quoted numbers, numeric zeros, no `_regione`, and lines that are no JSON."""
    folder = new_folder(spark, "landed-raw")
    key, third = F.col("o_orderkey"), F.col("o_orderkey") % 3
    amount = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("0")).otherwise(
        F.concat(F.lit('"'), t.dotted(t.cents("o_totalprice"), ","), F.lit('"'))
    )
    quote = F.when(third == 1, F.lit('"')).otherwise(F.lit(""))
    lat = F.concat(quote, t.text(F.col("o_custkey") % 90), F.lit(".5"), quote)
    place = F.when(third == 0, F.lit("")).otherwise(F.concat(F.lit(', "lat": '), lat, F.lit(', "lng": "7.25"')))
    line = F.concat(F.lit('{"id": '), t.text(key), F.lit(', "importo_lav_totale": '), amount, place, F.lit("}"))
    orders = t.table(spark, sf, "orders")
    broken = orders.where(F.col("o_orderstatus") == "P").select(F.lit("not json").alias("value"))
    # Spark names its files itself; the source names them by region.
    orders.select(line.alias("value")).unionByName(broken).write.text(folder)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    top = hadoop.Path(folder)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted(str(f.getPath()) for f in fs.globStatus(hadoop.Path(f"{folder}/part-*")))
    for k, part in enumerate(parts):
        fs.mkdirs(hadoop.Path(f"{folder}/{k}"))
        fs.rename(hadoop.Path(part), hadoop.Path(f"{folder}/{k}/PUGLIA.json"))
    works = landing.scan_works(spark, f"{folder}/*/*.json")
    projected = shape.project_snapshot(works).select("work_id", "region", "amount_total", "coordinate")
    # A line that is no JSON comes out as its text, beside blank fields.
    return projected.withColumn("broken", F.col("work_id") == "")


@query(
    "scan_dimension_files",
    """
    SELECT 'road' AS kind, CAST(n_nationkey AS VARCHAR) AS k, n_name AS v, CAST(NULL AS DOUBLE) AS lat FROM nation
    UNION ALL SELECT 'marker' AS kind, CAST(s_suppkey AS VARCHAR) AS k, '' AS v,
      CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey + 0.5 END AS lat FROM supplier""",
)
def scan_dimension_files(spark, sf):
    """Roads and markers landed as JSON and scanned; a marker's numbers are quoted, some are missing."""
    folder = new_folder(spark, "landed-dimensions")
    nation = t.table(spark, sf, "nation").select(t.text("n_nationkey").alias("codice"), F.col("n_name").alias("strada"))
    nation.write.json(f"{folder}/roads")
    even = F.col("s_suppkey") % 2 == 0
    lat = F.when(even, F.concat(t.text("s_suppkey"), F.lit(".5")))
    t.table(spark, sf, "supplier").select(t.text("s_suppkey").alias("id"), lat.alias("lat"), F.lit(1.0).alias("lng")).write.json(
        f"{folder}/markers"
    )
    roads = landing.scan_roads(spark, f"{folder}/roads").select(
        F.lit("road").alias("kind"), F.col("road_code").alias("k"), F.col("road_name").alias("v"), F.lit(None).cast("double").alias("lat")
    )
    markers = landing.scan_markers(spark, f"{folder}/markers").select(
        F.lit("marker").alias("kind"), F.col("id").alias("k"), F.lit("").alias("v"), "lat"
    )
    return roads.unionByName(markers)


@query(
    "scan_documents",
    """
    SELECT 'cache' AS kind, 'C' || c_custkey AS k, c_name AS v FROM customer
    UNION ALL SELECT 'deny' AS kind, 'C' || c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_acctbal < 0""",
)
def scan_documents(spark, sf):
    """The record cache and the deny-list as JSON documents, written and scanned with their field names mapped."""
    folder = new_folder(spark, "documents")
    customer = t.table(spark, sf, "customer").withColumn("k", F.concat(F.lit("C"), t.text("c_custkey")))
    record = F.struct(F.col("c_name").alias("Provincia"), F.lit("").alias("Settore"))
    customer.select(F.to_json(F.create_map("k", record)).alias("value")).write.text(f"{folder}/cache")
    entry = F.array(F.struct(F.col("k").alias("cup"), F.col("c_mktsegment").alias("regione")))
    owing = customer.where("c_acctbal < 0")
    owing.select(F.to_json(F.struct(entry.alias("entries"))).alias("value")).write.text(f"{folder}/deny")
    cached = documents.scan_cache(spark, f"{folder}/cache", multiline=False).select(
        F.lit("cache").alias("kind"), F.col("project_key").alias("k"), F.col("province").alias("v")
    )
    denied = documents.scan_denylist_lines(spark, f"{folder}/deny").select(
        F.lit("deny").alias("kind"), F.col("project_key").alias("k"), F.col("region").alias("v")
    )
    return cached.unionByName(denied)
