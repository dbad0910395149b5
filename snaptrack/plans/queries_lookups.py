"""Enrichment: worklist, record cache, safe writes, gazetteer fallback."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptrack.operators import enrich as E
from snaptrack.operators import views
from snaptrack.plans import tables as t
from snaptrack.plans.queries_works import RUN_1, SQL_ENTITY_VIEW, both_runs
from snaptrack.plans.registry import query
from snaptrack.plans.state import drop_expired_runs, enrich
from snaptrack.sources.documents import explode_json_map

FIELDS = ("official_name", "province", "municipalities")


def _entities(spark, sf):
    """Orders as entities, some already enriched, some with coordinates."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    region = t.table(spark, sf, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name")
    )
    return t.orders_with_nation(spark, sf).join(region, "n_regionkey").select(
        t.text("o_orderkey").alias("work_id"),
        F.concat(F.lit("C"), t.text("o_custkey"), F.lit(" ")).alias("project_key"),
        F.col("r_name").alias("region"),
        F.when(priority == "1-URGENT", F.lit("Non interessa")).otherwise(F.lit("")).alias("tag"),
        F.when(status == "F", F.lit("kept")).when(status == "O", F.lit("nan")).otherwise(F.lit("")).alias(
            "official_name"
        ),
        F.when(status == "P", F.lit("")).otherwise(F.col("n_name")).alias("province"),
        F.concat("c_mktsegment", F.lit("; "), "n_name").alias("municipalities"),
        F.when(priority == "2-HIGH", F.lit("1.000000, 2.000000"))
        .when(priority == "3-MEDIUM", F.lit("0.000000, 0.000000"))
        .otherwise(F.lit("")).alias("coordinate"),
    )


_SQL_ENTITIES = """
  entities AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS work_id, 'C' || o_custkey AS project_key, r_name AS region,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 'Non interessa' ELSE '' END AS tag,
      CASE o_orderstatus WHEN 'F' THEN 'kept' WHEN 'O' THEN 'nan' ELSE '' END AS official_name,
      CASE WHEN o_orderstatus = 'P' THEN '' ELSE n_name END AS province,
      c_mktsegment || '; ' || n_name AS municipalities,
      CASE o_orderpriority WHEN '2-HIGH' THEN '1.000000, 2.000000'
        WHEN '3-MEDIUM' THEN '0.000000, 0.000000' ELSE '' END AS coordinate,
      requested, requested AND o_orderstatus <> 'F' AS needs_record,
      requested AND o_orderpriority <> '2-HIGH' AS needs_coordinate
    FROM (SELECT *, o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority <> '1-URGENT'
                                  AND o_custkey % 3 <> 0) AS requested FROM orders)
      JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
      JOIN region ON r_regionkey = n_regionkey)"""


def _requested(spark, sf):
    """The projects somebody asked for: two in three of those with a row that is not denied."""
    keys = E.wanted_keys(_entities(spark, sf))
    return keys.where(F.substring("project_key", 2, 20).cast("long") % 3 != 0)


def _flagged(spark, sf):
    return E.worklist(_entities(spark, sf), keys=_requested(spark, sf))


def _cache(spark, sf):
    """Customers in credit have a cached record, some fields of it blank."""
    segment = F.col("c_mktsegment")
    return t.table(spark, sf, "customer").where(F.col("c_acctbal") > 0).select(
        F.concat(F.lit("C"), t.text("c_custkey")).alias("project_key"),
        F.when(segment == "MACHINERY", F.lit("nan")).otherwise(F.col("c_name")).alias("official_name"),
        F.when(segment == "BUILDING", F.lit(" ")).otherwise(segment).alias("province"),
        F.when(segment == "FURNITURE", F.lit("")).otherwise(F.lit("HOUSEHOLD, x")).alias("municipalities"),
    )


_SQL_CACHE = """
  cache AS (
    SELECT 'C' || c_custkey AS project_key,
      CASE c_mktsegment WHEN 'MACHINERY' THEN 'nan' ELSE c_name END AS official_name,
      CASE c_mktsegment WHEN 'BUILDING' THEN ' ' ELSE c_mktsegment END AS province,
      CASE c_mktsegment WHEN 'FURNITURE' THEN '' ELSE 'HOUSEHOLD, x' END AS municipalities
    FROM customer WHERE c_acctbal > 0)"""


@query(
    "enrichment_worklist",
    f"""WITH {_SQL_ENTITIES}
    SELECT work_id, needs_record, needs_coordinate, NOT needs_record AND NOT needs_coordinate AS complete
    FROM entities WHERE requested""",
)
def enrichment_worklist(spark, sf):
    flagged = _flagged(spark, sf).where("requested")
    return flagged.select("work_id", "needs_record", "needs_coordinate", "complete")


@query(
    "enrichment_keys",
    f"WITH {_SQL_ENTITIES} SELECT DISTINCT project_key FROM entities WHERE tag <> 'Non interessa'",
)
def enrichment_keys(spark, sf):
    return E.wanted_keys(_entities(spark, sf))


@query(
    "cache_missing_keys",
    f"""WITH {_SQL_ENTITIES}, {_SQL_CACHE}
    SELECT DISTINCT project_key FROM entities WHERE tag <> 'Non interessa'
      AND project_key NOT IN (SELECT project_key FROM cache)""",
)
def cache_missing_keys(spark, sf):
    return E.missing_keys(E.wanted_keys(_entities(spark, sf)), _cache(spark, sf))


def _sql_written(c: str) -> str:
    return f"needs_record AND coalesce(trim(cache.{c}), '') NOT IN ('', 'None', 'nan')"


_SQL_SAFE_WRITE = (
    f"WITH {_SQL_ENTITIES}, {_SQL_CACHE}, written AS (SELECT entities.*, "
    + ", ".join(
        f"CASE WHEN {_sql_written(c)} THEN cache.{c} ELSE entities.{c} END AS new_{c}" for c in FIELDS
    )
    + ", CAST("
    + " + ".join(f"CAST({_sql_written(c)} AS INTEGER)" for c in FIELDS)
    + " AS BIGINT) AS fields_written FROM entities LEFT JOIN cache USING (project_key))"
)


@query(
    "enrich_safe_write",
    _SQL_SAFE_WRITE
    + " SELECT work_id, fields_written, "
    + ", ".join(f"new_{c} AS {c}" for c in FIELDS)
    + " FROM written",
)
def enrich_safe_write(spark, sf):
    flagged = _flagged(spark, sf)
    written = E.safe_write(flagged, _cache(spark, sf), FIELDS)
    return written.select("work_id", "fields_written", *FIELDS)


@query(
    "cache_upsert",
    """
    SELECT 'P' || p_partkey AS project_key,
      CASE WHEN l.l_partkey IS NOT NULL AND p_type <> 'PROMO' THEN p_brand ELSE p_name END
        AS official_name
    FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity = 50) l
      ON l_partkey = p_partkey
    WHERE p_size <= 25 OR (l.l_partkey IS NOT NULL AND p_type <> 'PROMO')""",
)
def cache_upsert(spark, sf):
    part = t.table(spark, sf, "part").withColumn(
        "project_key", F.concat(F.lit("P"), t.text("p_partkey"))
    )
    cache = part.where(F.col("p_size") <= 25).select(
        "project_key", F.col("p_name").alias("official_name")
    )
    wanted = t.table(spark, sf, "lineitem").where(F.col("l_quantity") == 50).select(
        F.concat(F.lit("P"), t.text("l_partkey")).alias("project_key")
    )
    fetched = views.selected_rows(part, wanted, "project_key").select(
        "project_key",
        F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("official_name"),
    )
    return E.upsert_cache(cache, fetched, F.col("official_name").isNull())


def _gazetteer(spark, sf):
    """Suppliers as places; the municipality follows from the balance, some have no position."""
    balance = F.col("s_acctbal")
    municipality = (
        F.when(balance < 1500, F.lit("automobile")).when(balance < 3000, F.lit("BUILDING"))
        .when(balance < 5000, F.lit(" Furniture ")).when(balance < 6500, F.lit("HOUSEHOLD"))
        .otherwise(F.lit(""))
    )
    region = t.table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nation = t.table(spark, sf, "nation").join(region, "n_regionkey").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name", "r_name"
    )
    placed = F.col("s_nationkey") > 3
    return t.table(spark, sf, "supplier").join(nation, "s_nationkey").select(
        municipality.alias("municipality"), F.col("n_name").alias("province"),
        F.col("r_name").alias("region"), F.col("s_suppkey").alias("rank"),
        F.when(placed, F.col("s_nationkey")).otherwise(F.lit(0)).cast("double").alias("lat"),
        F.when(placed, F.col("s_suppkey")).otherwise(F.lit(0)).cast("double").alias("lng"),
    )


_SQL_GAZETTEER = """
  places AS (
    SELECT lower(CASE WHEN s_acctbal < 1500 THEN 'automobile' WHEN s_acctbal < 3000 THEN 'building'
        WHEN s_acctbal < 5000 THEN 'furniture' WHEN s_acctbal < 6500 THEN 'household' ELSE '' END) AS m,
      lower(n_name) AS p, lower(r_name) AS r, s_suppkey AS rank,
      CASE WHEN s_nationkey > 3 THEN s_nationkey || '.000000, ' || s_suppkey || '.000000' END AS found
    FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
  l1 AS (SELECT m, p, arg_min(coalesce(found, ''), rank) AS found FROM places WHERE m <> '' GROUP BY m, p),
  l2 AS (SELECT m, r, arg_min(coalesce(found, ''), rank) AS found FROM places WHERE m <> '' GROUP BY m, r),
  l3 AS (SELECT m, arg_min(coalesce(found, ''), rank) AS found FROM places WHERE m <> '' GROUP BY m),
  l4 AS (SELECT p, arg_min(coalesce(found, ''), rank) AS found FROM places GROUP BY p)"""


_SQL_FILLED = f"""WITH {_SQL_ENTITIES}, {_SQL_CACHE}, {_SQL_GAZETTEER},
    sources AS (
      SELECT entities.*,
        lower(trim(split_part(replace(CASE WHEN coalesce(cache.municipalities, '') <> ''
          THEN cache.municipalities ELSE entities.municipalities END, ';', ','), ',', 1))) AS m,
        lower(trim(CASE WHEN coalesce(cache.province, '') <> '' THEN cache.province
          ELSE entities.province END)) AS p,
        lower(region) AS r
      FROM entities LEFT JOIN cache USING (project_key)),
    resolved AS (
      SELECT sources.work_id, coordinate, needs_coordinate,
        CASE WHEN sources.m <> '' THEN coalesce(
            CASE WHEN sources.p <> '' THEN nullif(l1.found, '') END, nullif(l2.found, ''),
            nullif(l3.found, ''))
          ELSE nullif(l4.found, '') END AS hit
      FROM sources LEFT JOIN l1 ON l1.m = sources.m AND l1.p = sources.p
        LEFT JOIN l2 ON l2.m = sources.m AND l2.r = sources.r
        LEFT JOIN l3 ON l3.m = sources.m LEFT JOIN l4 ON l4.p = sources.p),
    filled AS (
      SELECT work_id, needs_coordinate, CASE WHEN needs_coordinate AND hit IS NOT NULL THEN hit ELSE coordinate END
        AS coordinate, needs_coordinate AND hit IS NOT NULL AS coordinate_found
    FROM resolved)"""


@query(
    "fallback_lookup", _SQL_FILLED + " SELECT work_id, coordinate, coordinate_found FROM filled"
)
def fallback_lookup(spark, sf):
    flagged = _flagged(spark, sf)
    filled = E.fill_coordinates(flagged, _gazetteer(spark, sf), _cache(spark, sf))
    return filled.select("work_id", "coordinate", "coordinate_found")


@query(
    "coordinate_counters",
    _SQL_FILLED + """ SELECT CAST(count(*) FILTER (coordinate_found) AS BIGINT) AS found,
      CAST(count(*) FILTER (needs_coordinate) AS BIGINT) AS looked_up FROM filled""",
)
def coordinate_counters(spark, sf):
    filled = E.fill_coordinates(_flagged(spark, sf), _gazetteer(spark, sf), _cache(spark, sf))
    return filled.agg(F.count_if("coordinate_found").alias("found"), F.count_if("needs_coordinate").alias("looked_up"))


@query(
    "enrichment_counters",
    f"""WITH {_SQL_ENTITIES}
    SELECT CAST(count(*) AS BIGINT) AS rows_touched,
      CAST(count(*) FILTER (needs_record) AS BIGINT) AS rows_need_record,
      CAST(count(DISTINCT CASE WHEN needs_record THEN project_key END) AS BIGINT) AS keys_need_record,
      CAST(count(*) FILTER (needs_coordinate) AS BIGINT) AS rows_need_coordinate,
      CAST(count(*) FILTER (NOT needs_record AND NOT needs_coordinate) AS BIGINT) AS rows_complete
    FROM entities WHERE requested""",
)
def enrichment_counters(spark, sf):
    return E.worklist_counters(_flagged(spark, sf))


@query(
    "enrichment_written_counters",
    _SQL_SAFE_WRITE
    + """ SELECT CAST(sum(fields_written) AS BIGINT) AS fields_written,
            CAST(count(*) FILTER (fields_written > 0) AS BIGINT) AS rows_written FROM written""",
)
def enrichment_written_counters(spark, sf):
    written = E.safe_write(_flagged(spark, sf), _cache(spark, sf), FIELDS)
    return written.agg(
        F.sum("fields_written").alias("fields_written"),
        F.count_if(F.col("fields_written") > 0).alias("rows_written"),
    )


@query(
    "cache_explode_map",
    """
    SELECT event_id, 'k' AS key, CAST(json_extract(props, '$.k') AS INTEGER) AS value FROM events""",
)
def cache_explode_map(spark, sf):
    schema = T.MapType(T.StringType(), T.IntegerType())
    return explode_json_map(
        t.table(spark, sf, "events").select("event_id", "props"), "props", schema, "key", "value"
    )


@query(
    "semi_join_selection",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def semi_join_selection(spark, sf):
    chosen = t.table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey")
    )
    orders = t.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return views.selected_rows(orders, chosen, "o_custkey").select("o_orderkey", "o_custkey")


def registry_pages(spark, sf):
    """A registry page, with the registry's own landmarks, for every customer in credit."""
    nation = t.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customer = t.table(spark, sf, "customer").where(F.col("c_acctbal") > 0).join(nation, "c_nationkey")

    def line(*parts):
        return F.concat(F.lit("<p>"), *parts, F.lit("</p>"))

    html = F.concat(
        line(F.lit("Dettaglio Progetto")), line(F.col("c_name")),
        line(F.lit("Provincia")), line(F.col("n_name")), line(F.lit("Comune")), line(F.col("c_mktsegment"), F.lit(", x")),
    )
    return customer.select(F.concat(F.lit("C"), t.text("c_custkey")).alias("project_key"), html.alias("html"))


@query(
    "enrich_into_state",
    SQL_ENTITY_VIEW
    + f""", {_SQL_GAZETTEER.strip()},
    asked AS (
      SELECT m.*, c_custkey % 3 <> 0 AS requested, c_custkey % 3 <> 0 AND c_acctbal > 0 AS filled, c_name, c_mktsegment, n_name
      FROM merged m JOIN customer ON 'C' || c_custkey = m.project_key JOIN nation ON n_nationkey = c_nationkey),
    placed AS (
      SELECT asked.*, CASE WHEN filled THEN coalesce(nullif(l1.found, ''), nullif(l3.found, '')) END AS hit
      FROM asked LEFT JOIN l1 ON l1.m = lower(c_mktsegment) AND l1.p = lower(n_name) LEFT JOIN l3 ON l3.m = lower(c_mktsegment))
    SELECT work_id, CASE WHEN filled THEN c_name ELSE '' END AS official_name,
      CASE WHEN filled THEN n_name ELSE '' END AS province,
      CASE WHEN filled THEN c_mktsegment || ', x' ELSE '' END AS municipalities,
      CASE WHEN trim(coordinate) IN ('', 'None', 'nan', '0.000000, 0.000000') AND hit IS NOT NULL THEN hit
        ELSE coordinate END AS coordinate
    FROM placed""",
)
def enrich_into_state(spark, sf):
    """Two runs, then the requested projects filled from pages, cache and gazetteer, stored and read back."""
    state = both_runs(spark, sf)
    keys = t.table(spark, sf, "customer").where(F.col("c_custkey") % 3 != 0).select(
        F.concat(F.lit("C"), t.text("c_custkey")).alias("project_key")
    )
    enrich(state, registry_pages(spark, sf), _gazetteer(spark, sf), keys)
    return state.entities().select("work_id", "official_name", "province", "municipalities", "coordinate")


@query(
    "drop_expired_snapshots",
    f"""{t.SQL_MATCHED} SELECT label, CAST(count(*) AS BIGINT) AS works,
      CAST((SELECT count(*) FROM s2) AS BIGINT) AS left_rows,
      CAST((SELECT count(*) FROM s1) AS BIGINT) AS folded_rows
    FROM labelled GROUP BY label""",
)
def drop_expired_snapshots(spark, sf):
    """Retention of one run after two: the labels afterwards, the rows still stored as a snapshot and
    those that went behind the horizon."""
    state = both_runs(spark, sf)
    drop_expired_runs(state, keep=1)
    left, folded = state.log().count(), state.snapshot_of(RUN_1).count()
    shown = state.labelled().groupBy("label").agg(F.count("*").alias("works"))
    return shown.select("label", "works", *[F.lit(n).cast("long").alias(c) for c, n in
                                            (("left_rows", left), ("folded_rows", folded))])
