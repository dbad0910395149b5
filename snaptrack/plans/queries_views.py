"""What a reader of the entity table asks for."""

from __future__ import annotations

from pyspark.sql import functions as F

from snaptrack.operators import views
from snaptrack.plans import tables as t
from snaptrack.plans.queries_works import SQL_ENTITY_VIEW, entity_view
from snaptrack.plans.registry import query
from snaptrack.schemas import strings
from snaptrack.sources import snapshots as files
from snaptrack.sources.shared import new_folder


@query(
    "filter_view",
    SQL_ENTITY_VIEW
    + """ SELECT work_id, region, work_type, label FROM viewed
          WHERE trim(region) IN ('nation_1', 'nation_2', 'NATION_3') AND work_type IN ('BUILDING', 'MACHINERY')
            AND (pct_now IS NULL OR pct_now BETWEEN 10 AND 90)
            AND (label IN ('Obra Nueva', 'Obra Desaparecida') OR regexp_matches(label, '^[+-]?[0-9]'))
            AND (regexp_matches(description, 'urgent|high', 'i')
                 OR regexp_matches(contractor, 'urgent|high', 'i'))""",
)
def filter_view(spark, sf):
    """Every filter at once over the merged, labelled entities."""
    shown = views.view(
        entity_view(spark, sf),
        regions=["  nation_1", "  nation_2", "NATION_3"],
        work_types=["BUILDING", "MACHINERY"],
        progress=(10, 90),
        labels=["Obra Nueva", "Obra Desaparecida"],
        query="urgent|high",
    )
    return shown.select("work_id", "region", "work_type", "label")


@query(
    "filter_view_everything",
    SQL_ENTITY_VIEW
    + " SELECT work_id, label, region, amount_total FROM viewed WHERE pct_now IS NULL OR pct_now BETWEEN 0 AND 100",
)
def filter_view_everything(spark, sf):
    """No selection keeps all merged entities, those without progress too."""
    return views.view(entity_view(spark, sf)).select("work_id", "label", "region", "amount_total")


@query(
    "tag_partition",
    f"WITH {t.SQL_TAGGED} SELECT work_id, tag, 'one' AS tab FROM tagged WHERE tag = 'In VTiger'"
    " UNION ALL SELECT work_id, tag, 'open' AS tab FROM tagged WHERE tag = ''"
    " UNION ALL SELECT work_id, tag, 'all' AS tab FROM tagged",
)
def tag_partition(spark, sf):
    """The tabs of a view: rows of a tag, rows without one, all rows."""
    rows = t.tagged_orders(spark, sf)
    tabs = {"one": "In VTiger", "open": "", "all": None}
    parts = [views.with_tag(rows, tag).select("work_id", "tag", F.lit(tab).alias("tab")) for tab, tag in tabs.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "search_any_column",
    """
    SELECT doc_id, lang FROM documents
    WHERE regexp_matches(text, 'est le|the and', 'i') OR regexp_matches(source, 'est le|the and', 'i')""",
)
def search_any_column(spark, sf):
    documents = t.table(spark, sf, "documents")
    return views.search(documents, "EST LE|the and", ["text", "source", "absent"]).select("doc_id", "lang")


@query(
    "search_literal",
    "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_brand), 'brand#1')",
)
def search_literal(spark, sf):
    part = t.table(spark, sf, "part")
    return views.search(part, "BRAND#1", ["p_brand"], regex=False).select("p_partkey", "p_name")


@query(
    "facet_values",
    "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL ORDER BY p_brand",
)
def facet_values(spark, sf):
    return views.facet_values(t.table(spark, sf, "part"), "p_brand")


@query(
    "export_view",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer""",
)
def export_view(spark, sf):
    """The view as CSV, helper columns left out, read back."""
    folder = new_folder(spark, "export")
    shown = t.table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").alias("_helper")
    )
    files.write_csv(views.exportable(shown), folder)
    return files.scan_csv(spark, folder, strings("c_custkey", "c_name", "c_mktsegment"))


@query(
    "display_columns",
    SQL_ENTITY_VIEW
    + """ SELECT '' AS tag, region, project_key, label,
            CASE WHEN coordinate IN ('', 'nan') THEN ''
              ELSE 'https://www.google.com/maps?q=' || replace(coordinate, ', ', ',') END AS coordinate
          FROM viewed""",
)
def display_columns(spark, sf):
    """Chosen columns of the merged entities, label and tag added, helpers left out."""
    rows = entity_view(spark, sf).withColumn("_hidden", F.lit(1))
    return views.display(rows, ["region", "project_key", "coordinate", "_hidden", "absent"])
