"""Deny-list and user tags."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from snaptrack.operators import denylist as D
from snaptrack.operators import views
from snaptrack.plans import tables as t
from snaptrack.plans.registry import query
from snaptrack.sources.documents import parse_deny_document

TODAY = date(2024, 7, 1)

_DENY = f"WITH {t.sql_deny()}"
_KEYED = "trim(project_key) AS k, lower(trim(region)) AS r"


def _json(shape: dict[str, object]):
    """JSON text of a struct of columns; null members are left out."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in shape.items()]))


@query(
    "denylist_load_legacy",
    """
    SELECT c_custkey, 'C' || c_custkey AS project_key,
      CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_mktsegment ELSE '' END AS region,
      CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_name ELSE '' END AS contractor
    FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""",
)
def denylist_load_legacy(spark, sf):
    segment, none = F.col("c_mktsegment"), F.array().cast("array<string>")
    key = F.concat(F.lit("C"), t.text("c_custkey"))
    keys = F.array(F.concat(F.lit(" "), key), F.lit("  "))
    entry = F.struct(key.alias("cup"), segment.alias("regione"), F.col("c_name").alias("impresa"))
    keyless = F.struct(F.lit("").alias("cup"), segment.alias("regione"), F.col("c_name").alias("impresa"))
    document = (
        F.when(segment == "AUTOMOBILE", _json({"entries": F.array(entry, keyless)}))
        .when(segment == "BUILDING", _json({"cups": keys}))
        .when(segment == "FURNITURE", _json({"ids": keys}))
        .when(segment == "HOUSEHOLD", _json({"entries": none, "cups": keys}))
        .otherwise(_json({"cups": none, "ids": keys}))
    )
    documents = t.table(spark, sf, "customer").select(
        "c_custkey", parse_deny_document(document).alias("d")
    )
    return D.explode_entries(documents, "d", "c_custkey").select(
        "c_custkey", "project_key", "region", "contractor"
    )


@query(
    "denylist_compact",
    """
    WITH e AS (
      SELECT 'K' || c_mktsegment AS project_key, n_name AS region, repeat(c_name || ' ', 10) AS description,
        c_name AS contractor, CASE WHEN c_acctbal < 0 THEN '2024-01-01' ELSE '' END AS added_on,
        row_number() OVER (PARTITION BY c_mktsegment, n_name ORDER BY c_custkey) AS rn
      FROM customer JOIN nation ON n_nationkey = c_nationkey)
    SELECT project_key, region, contractor, substr(trim(description), 1, 140) AS description,
      CASE WHEN added_on = '' THEN '2024-07-01' ELSE added_on END AS added_on
    FROM e WHERE rn = 1""",
)
def denylist_compact(spark, sf):
    nation = t.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    entries = t.table(spark, sf, "customer").join(nation, "c_nationkey").select(
        F.concat(F.lit(" K"), "c_mktsegment").alias("project_key"),
        F.concat("n_name", F.lit("\t")).alias("region"),
        F.col("c_name").alias("contractor"),
        F.repeat(F.concat("c_name", F.lit(" ")), F.lit(10)).alias("description"),
        F.when(F.col("c_acctbal") < 0, F.lit("2024-01-01")).otherwise(F.lit("")).alias("added_on"),
        F.col("c_custkey").alias("seq"),
    )
    return D.compact(entries, TODAY)


@query(
    "denylist_add",
    f"""
    WITH {t.sql_deny()}, {t.sql_deny('more', 1500.0)}
    SELECT project_key, region, contractor, added_on, FALSE AS added FROM deny
    UNION ALL
    SELECT trim(project_key), trim(region), contractor, '2024-07-01' AS added_on, TRUE AS added
    FROM more
    WHERE NOT EXISTS (SELECT 1 FROM deny WHERE deny.project_key = more.project_key
                        AND lower(trim(deny.region)) = lower(trim(more.region)))""",
)
def denylist_add(spark, sf):
    candidates = D.entries_from_rows(t.deny_entries(spark, sf, 1500.0))
    listed = D.add(t.deny_entries(spark, sf), candidates, TODAY)
    return listed.select("project_key", "region", "contractor", "added_on", "added")


@query(
    "denylist_remove",
    _DENY
    + f""" SELECT project_key, region FROM deny
          WHERE project_key NOT IN (SELECT 'C' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
            AND NOT EXISTS (SELECT 1 FROM customer JOIN nation ON n_nationkey = c_nationkey
              WHERE c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') AND 'C' || c_custkey = deny.project_key
                AND lower(n_name) = lower(trim(deny.region)))""",
)
def denylist_remove(spark, sf):
    nation = t.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = t.table(spark, sf, "customer").join(nation, "c_nationkey").select(
        "c_mktsegment",
        F.concat(F.lit(" C"), t.text("c_custkey")).alias("project_key"),
        F.upper("n_name").alias("region"),
    )
    bare = customers.where(F.col("c_mktsegment") == "BUILDING")
    pairs = customers.where(F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE"))
    return D.remove(t.deny_entries(spark, sf), bare, pairs).select("project_key", "region")


_SQL_DENIED = f"""WITH {t.SQL_TAGGED}, {t.sql_deny()},
  flagged AS (
    SELECT *, EXISTS (SELECT 1 FROM deny WHERE deny.project_key = tagged.project_key
        AND (trim(deny.region) = '' OR tagged.region = ''
             OR lower(trim(deny.region)) = lower(tagged.region))) AS denied
    FROM tagged)"""


@query(
    "denylist_tag",
    _SQL_DENIED
    + """ SELECT work_id, project_key, region,
            CASE WHEN denied AND tag = '' THEN 'Non interessa' ELSE tag END AS tag FROM flagged""",
)
def denylist_tag(spark, sf):
    return D.tag_denied(t.tagged_orders(spark, sf), t.deny_entries(spark, sf))


@query(
    "denylist_tag_force",
    _SQL_DENIED
    + """ SELECT work_id, project_key, region,
            CASE WHEN denied THEN 'Non interessa' ELSE tag END AS tag FROM flagged""",
)
def denylist_tag_force(spark, sf):
    rows, entries = t.tagged_orders(spark, sf), t.deny_entries(spark, sf)
    return D.tag_denied(rows, entries, only_blank=False)


@query(
    "denylist_counts",
    _SQL_DENIED
    + """ SELECT CAST(count(*) FILTER (denied) AS BIGINT) AS rows_denied,
            CAST(count(*) FILTER (denied AND tag = '') AS BIGINT) AS rows_tagged FROM flagged""",
)
def denylist_counts(spark, sf):
    rows = D.with_denied(t.tagged_orders(spark, sf), t.deny_entries(spark, sf))
    return rows.agg(
        F.count_if("denied").alias("rows_denied"),
        F.count_if(F.col("denied") & (F.col("tag") == "")).alias("rows_tagged"),
    )


_SQL_EDITS = """
  edits AS (
    SELECT * FROM (
      SELECT CAST(l_orderkey AS VARCHAR) AS work_id,
        CASE l_returnflag WHEN 'A' THEN 'Da caricare' WHEN 'R' THEN 'Non interessa' ELSE '' END
          AS new_tag,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
          l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_returnflag DESC) AS rn
      FROM lineitem WHERE l_discount = 0.05) WHERE rn = 1)"""


def _edits(spark, sf):
    flag = F.col("l_returnflag")
    new_tag = F.when(flag == "A", F.lit("Da caricare")).when(flag == "R", F.lit("Non interessa"))
    return t.table(spark, sf, "lineitem").where(F.col("l_discount") == 0.05).select(
        t.text("l_orderkey").alias("work_id"),
        F.struct(
            "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"
        ).alias("seq"),
        new_tag.otherwise(F.lit("")).alias("new_tag"),
    )


@query(
    "apply_tag_edits",
    f"""WITH {t.SQL_TAGGED}, {_SQL_EDITS}
    SELECT work_id, coalesce(new_tag, tag) AS tag FROM tagged LEFT JOIN edits USING (work_id)""",
)
def apply_tag_edits(spark, sf):
    return D.apply_edits(t.tagged_orders(spark, sf), _edits(spark, sf)).select("work_id", "tag")


@query(
    "denylist_sync_edits",
    f"""WITH {t.SQL_TAGGED}, {_SQL_EDITS}, {t.sql_deny()},
    changed AS (SELECT tagged.*, new_tag FROM tagged JOIN edits USING (work_id)),
    joining AS (SELECT DISTINCT project_key, lower(trim(region)) AS r FROM changed
                WHERE new_tag = 'Non interessa'),
    leaving AS (SELECT DISTINCT project_key, lower(trim(region)) AS r FROM changed
                WHERE new_tag <> 'Non interessa'),
    listed AS (SELECT project_key, lower(trim(region)) AS r FROM deny
               UNION SELECT project_key, r FROM joining)
    SELECT project_key, r AS region FROM listed
    WHERE NOT EXISTS (SELECT 1 FROM leaving WHERE leaving.project_key = listed.project_key
                        AND leaving.r = listed.r)""",
)
def denylist_sync_edits(spark, sf):
    last = D.latest_edits(_edits(spark, sf))
    changed = (
        t.tagged_orders(spark, sf).join(last.select("work_id", "new_tag"), "work_id")
        .select("*", F.lit("").alias("contractor"), F.lit("").alias("description"),
                F.col("work_id").cast("long").alias("seq"))
    )
    current = t.deny_entries(spark, sf).drop("segment")
    listed = D.sync_with_edits(current, changed, TODAY)
    return listed.select("project_key", F.lower(F.trim("region")).alias("region"))


@query(
    "tag_partition_counts",
    f"""WITH {t.SQL_TAGGED}, {_SQL_EDITS},
    now AS (SELECT coalesce(new_tag, tag) AS tag FROM tagged LEFT JOIN edits USING (work_id))
    SELECT CASE tag WHEN '' THEN 'Da valutare' ELSE tag END AS shown_as,
      CAST(count(*) AS BIGINT) AS works FROM now GROUP BY 1
    UNION ALL SELECT 'Tutte', CAST(count(*) AS BIGINT) FROM now""",
)
def tag_partition_counts(spark, sf):
    return views.tag_counts(D.apply_edits(t.tagged_orders(spark, sf), _edits(spark, sf)))


@query(
    "migrate_flag",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
        THEN 'In VTiger' ELSE '' END AS tag FROM customer""",
)
def migrate_flag(spark, sf):
    from snaptrack.operators.shape import migrate_flag as migrate

    spelling = F.create_map(
        *[F.lit(x) for x in ("AUTOMOBILE", " Sì ", "BUILDING", "TRUE", "MACHINERY", "1",
                             "HOUSEHOLD", "no")]
    )
    customer = t.table(spark, sf, "customer")
    return migrate(customer.select("c_custkey", spelling[F.col("c_mktsegment")].alias("VTiger")))
