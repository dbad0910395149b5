"""The engine's logical tables, derived from the given tables, in Spark and in SQL.

Works are the orders with their lines. The lines already filled (status F) are the older
snapshot of two, the open ones (status O) the newer, so most works are in both and some in one
only, and a work with several lines in a snapshot appears there several times. The history is
the `events` table: a day is a run, (user, event type) an entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snaptrack.functions.numbers import parse_pct
from snaptrack.operators.dedupe import keep_first
from snaptrack.schemas import RECORD_COLUMNS, SNAPSHOT_COLUMNS

OLD, NEW = "F", "O"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its schema is taken from the files once, not on every use."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a table out evenly, whatever its size: heavy work per row would otherwise run in the tasks
    that happen to read its few files."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("long")


def dotted(hundredths: Column, point: str) -> Column:
    """Integer hundredths as decimal text."""
    whole = F.floor(hundredths / 100)
    return F.concat(text(whole), F.lit(point), F.lpad(text(hundredths - whole * 100), 2, "0"))


def line_table(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with their order, customer and nation.

    Orders grow with the lines, so they meet in a shuffle join, whose skewed partitions AQE
    can split; the estimate of a join's size would otherwise pick the lines for broadcast.
    """
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customer = table(spark, sf, "customer").join(nation, "c_nationkey")
    orders = table(spark, sf, "orders").join(
        customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"
    )
    return table(spark, sf, "lineitem").join(
        orders.withColumnRenamed("o_orderkey", "l_orderkey").hint("merge"), "l_orderkey"
    )


def progress_text() -> Column:
    x = F.least(
        F.lit(10000),
        F.col("l_quantity").cast("long") * 200 + cents("l_discount") * 13 + cents("l_tax") * 7,
    )
    nothing = (F.col("l_discount") == 0) & (F.col("l_tax") == 0)
    return F.when(nothing, F.lit("")).otherwise(dotted(x, ","))


def works_snapshot(spark: SparkSession, sf: str, status: str) -> DataFrame:
    """The snapshot of one line status, all columns text, several rows per work."""
    flag, supplier = F.col("l_returnflag"), text("l_suppkey")
    km_from = text("l_linenumber")
    km_to = text(F.col("l_linenumber") + F.col("l_quantity").cast("int"))
    region = F.col("n_name") if status == OLD else F.concat(F.lit("  "), F.lower("n_name"))
    # The newer snapshot has other totals, and some it does not know.
    newer = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(
        dotted(cents("o_totalprice") + 100, ".")
    )
    total = dotted(cents("o_totalprice"), ".") if status == OLD else newer
    road = F.concat(F.lit("R"), supplier)
    columns = {
        "work_id": text("l_orderkey"),
        "region": region,
        "road_code": road,
        "road_name": F.concat(F.lit("Road "), supplier),
        "project_key": F.concat(F.lit("C"), text("o_custkey")),
        "description": F.concat_ws(" ", "o_orderpriority", "l_returnflag"),
        "work_type": F.col("c_mktsegment"),
        "contractor": F.when(flag == "A", F.lit("")).when(flag == "N", F.lit("nan")).otherwise(
            F.concat(F.lit("Supplier "), supplier)
        ),
        "amount_main": dotted(cents("l_extendedprice"), "."),
        "amount_total": total,
        "delivered_on": F.date_format("l_shipdate", "dd-MM-yyyy"),
        "progress": progress_text(),
        "due_on": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "km_from": km_from,
        "km_to": km_to,
        "segments": F.concat(road, F.lit(" "), km_from, F.lit("–"), km_to),
        "coordinate": F.when(flag == "A", F.lit(""))
        .when(flag == "N", F.lit("0.000000, 0.000000"))
        .otherwise(F.concat(text("c_nationkey"), F.lit(".000000, "), km_from, F.lit(".000000"))),
        **{c: F.lit("") for c in RECORD_COLUMNS},
    }
    lines = line_table(spark, sf).where(F.col("l_linestatus") == status)
    return lines.select(*[columns[c].alias(c) for c in SNAPSHOT_COLUMNS])


def events_history(spark: SparkSession, sf: str, unit: str = "day") -> DataFrame:
    """Observations: the first event of an entity in a run counts; small values are blank."""
    value = F.col("value")
    rows = table(spark, sf, "events").select(
        "user_id",
        "event_type",
        F.date_trunc(unit, "ts").alias("run_ts"),
        "ts",
        "event_id",
        F.when(value < 5, F.lit("")).otherwise(F.replace(text("value"), F.lit("."), F.lit(","))).alias(
            "pct_text"
        ),
    )
    first = keep_first(rows, ["user_id", "event_type", "run_ts"], ["ts", "event_id"])
    return first.select(
        *ENTITY, "run_ts", "pct_text", parse_pct(F.col("pct_text")).alias("pct")
    )


ENTITY = ["user_id", "event_type"]


def orders_with_nation(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"
    )
    customer = table(spark, sf, "customer").join(nation, "c_nationkey")
    return table(spark, sf, "orders").join(
        customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"
    )


def tagged_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Entity rows with a user tag; a blank region makes a row match any region."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return orders_with_nation(spark, sf).select(
        text("o_orderkey").alias("work_id"),
        F.concat(F.lit("C"), text("o_custkey")).alias("project_key"),
        F.when(priority == "5-LOW", F.lit("")).otherwise(F.upper("n_name")).alias("region"),
        F.when(status == "P", F.lit("In VTiger")).otherwise(F.lit("")).alias("tag"),
    )


def deny_entries(spark: SparkSession, sf: str, below: float = 0.0) -> DataFrame:
    """Customers in debt, under four kinds of region spelling."""
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    segment = F.col("c_mktsegment")
    region = (
        F.when(segment == "MACHINERY", F.lit(""))
        .when(segment == "BUILDING", F.concat(F.lit(" "), F.lower("n_name")))
        .when(segment == "FURNITURE", F.lit("elsewhere"))
        .otherwise(F.col("n_name"))
    )
    owing = table(spark, sf, "customer").where(F.col("c_acctbal") < below)
    return owing.join(nation, "c_nationkey").select(
        F.concat(F.lit("C"), text("c_custkey")).alias("project_key"),
        region.alias("region"),
        F.col("c_name").alias("contractor"),
        segment.alias("description"),
        F.lit("2024-01-01").alias("added_on"),
        F.col("c_custkey").alias("seq"),
        segment.alias("segment"),
    )


# ---------------------------------------------------------------------------------------------
# The same tables in SQL.

_LINES = """
  lines AS (
    SELECT l.*, o.o_custkey, o.o_orderpriority, o.o_totalprice, o.o_orderdate,
           c.c_mktsegment, c.c_nationkey, n.n_name
    FROM lineitem l
    JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey
  )"""

_X = (
    "least(10000, CAST(l_quantity AS BIGINT) * 200 + CAST(round(l_discount * 100) AS BIGINT) * 13"
    " + CAST(round(l_tax * 100) AS BIGINT) * 7)"
)


def sql_dotted(hundredths: str, point: str) -> str:
    return (
        f"(CAST(({hundredths}) // 100 AS VARCHAR) || '{point}' || "
        f"lpad(CAST(({hundredths}) % 100 AS VARCHAR), 2, '0'))"
    )


def _sql_snapshot(name: str, status: str) -> str:
    region = "n_name" if status == OLD else "'  ' || lower(n_name)"
    price = "CAST(round(l_extendedprice * 100) AS BIGINT)"
    cents_ = "CAST(round(o_totalprice * 100) AS BIGINT)"
    total = sql_dotted(cents_, ".") if status == OLD else (
        f"CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE {sql_dotted(cents_ + ' + 100', '.')} END"
    )
    return f"""
  {name}_rows AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS work_id, {region} AS region,
      'R' || l_suppkey AS road_code, 'Road ' || l_suppkey AS road_name,
      'C' || o_custkey AS project_key, o_orderpriority || ' ' || l_returnflag AS description,
      c_mktsegment AS work_type,
      CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN 'nan' ELSE 'Supplier ' || l_suppkey END
        AS contractor,
      {sql_dotted(price, '.')} AS amount_main, {total} AS amount_total,
      strftime(l_shipdate, '%d-%m-%Y') AS delivered_on,
      CASE WHEN l_discount = 0 AND l_tax = 0 THEN '' ELSE {sql_dotted(_X, ',')} END AS progress,
      strftime(o_orderdate, '%Y-%m-%d') AS due_on,
      CAST(l_linenumber AS VARCHAR) AS km_from,
      CAST(l_linenumber + CAST(l_quantity AS INTEGER) AS VARCHAR) AS km_to,
      'R' || l_suppkey || ' ' || l_linenumber || '–'
        || (l_linenumber + CAST(l_quantity AS INTEGER)) AS segments,
      CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN '0.000000, 0.000000'
        ELSE c_nationkey || '.000000, ' || l_linenumber || '.000000' END AS coordinate
    FROM lines WHERE l_linestatus = '{status}'
  ),
  {name} AS (
    SELECT *, trim(project_key) AS sig_project, lower(trim(region)) AS sig_region,
      trim(work_id) AS sig_id,
      try_cast(replace(progress, ',', '.') AS DOUBLE) AS pct
    FROM (
      SELECT *, row_number() OVER (PARTITION BY work_id ORDER BY road_code, region, road_name,
        project_key, description, work_type, contractor, amount_main, amount_total, delivered_on,
        progress, due_on, km_from, km_to, segments, coordinate) AS rn
      FROM {name}_rows) WHERE rn = 1
  )"""


SQL_WORKS = f"WITH {_LINES}, {_sql_snapshot('s1', OLD)}, {_sql_snapshot('s2', NEW)}"

SQL_MATCHED = (
    SQL_WORKS
    + """,
  matched AS (
    SELECT sig_project, sig_region, sig_id,
      CASE WHEN s1.work_id IS NULL THEN 'new' WHEN s2.work_id IS NULL THEN 'gone' ELSE 'both' END
        AS status,
      s1.pct AS pct1, s2.pct AS pct2,
      CASE WHEN s1.work_id IS NULL THEN s2.amount_total WHEN s2.work_id IS NULL THEN s1.amount_total
        WHEN trim(s2.amount_total) IN ('', 'None', 'nan') THEN s1.amount_total ELSE s2.amount_total END
        AS amount_total
    FROM s1 FULL OUTER JOIN s2 USING (sig_project, sig_region, sig_id)
  ),
  labelled AS (
    SELECT *,
      CASE WHEN status = 'new' THEN 'Obra Nueva'
        WHEN status = 'gone' AND pct1 >= 100 THEN 'Obra Conclusa'
        WHEN status = 'gone' AND pct1 >= 80 THEN 'Obra Conclusa (probable)'
        WHEN status = 'gone' THEN 'Obra Desaparecida'
        WHEN pct2 - pct1 > 0 THEN '+' || printf('%.1f', pct2 - pct1) || '%'
        WHEN pct2 - pct1 < 0 THEN printf('%.1f', pct2 - pct1) || '%'
        WHEN pct2 - pct1 = 0 THEN '0%'
        ELSE '' END AS label
    FROM matched
  )"""
)


def sql_history(unit: str = "day") -> str:
    return f"""
  raw_history AS (
    SELECT user_id, event_type, run_ts, pct_text,
      try_cast(replace(pct_text, ',', '.') AS DOUBLE) AS pct
    FROM (
      SELECT user_id, event_type, date_trunc('{unit}', ts) AS run_ts,
        CASE WHEN value < 5 THEN '' ELSE replace(CAST(value AS VARCHAR), '.', ',') END AS pct_text,
        row_number() OVER (PARTITION BY user_id, event_type, date_trunc('{unit}', ts)
                           ORDER BY ts, event_id) AS rn
      FROM events) WHERE rn = 1
  )"""


SQL_TAGGED = """
  tagged AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS work_id, 'C' || o_custkey AS project_key,
      CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE upper(n_name) END AS region,
      CASE WHEN o_orderstatus = 'P' THEN 'In VTiger' ELSE '' END AS tag
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  )"""


def sql_deny(name: str = "deny", below: float = 0.0) -> str:
    return f"""
  {name} AS (
    SELECT 'C' || c_custkey AS project_key,
      CASE c_mktsegment WHEN 'MACHINERY' THEN '' WHEN 'BUILDING' THEN ' ' || lower(n_name)
        WHEN 'FURNITURE' THEN 'elsewhere' ELSE n_name END AS region,
      c_name AS contractor, c_mktsegment AS description, '2024-01-01' AS added_on,
      c_custkey AS seq, c_mktsegment AS segment
    FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal < {below}
  )"""
