"""What Spark makes of the operators."""

import contextlib

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from snaptrack.plans.catalog import QUERIES
from snaptrack.operators import denylist, enrich, shape, views

SF = "/root/testdata/sf0.001"
ROWS = 60_000
RUNS_JOBS = {"scan_nested_json", "snapshot_roundtrip", "snapshot_runs_table", "export_view",
             "stream_ingest_snapshots", "stream_lifecycle", "ingest_runs_into_state", "tag_edits_into_state",
             "stream_into_state", "enrich_into_state", "scan_csv_by_name", "scan_raw_as_landed",
             "scan_dimension_files", "scan_documents", "drop_expired_snapshots",
             "labels_after_retention", "history_after_retention", "changes_between_commits", "state_as_of_commit",
             "master_into_state", "quarantine_into_state", "presence_between_runs", "presence_first_seen",
             "presence_members", "unknown_fields_drift", "unknown_fields_in_state"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RUNS_JOBS))
def test_no_query_crosses_tables_or_leaves_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not [word for word in FORBIDDEN if word in plan]


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["retain_last_n_runs"](spark, SF))
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]
    plan = plan_of(QUERIES["apply_tag_edits"](spark, SF))
    assert "EqualTo(l_discount,0.05)" in plan


def _big(spark):
    # A third of all rows belong to one project.
    key = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 5000).cast("string")))
    return spark.range(0, ROWS, 1, 8).select(
        F.col("id").cast("string").alias("work_id"), key.alias("project_key"), F.lit("r").alias("region"),
        F.lit("").alias("tag"), F.lit("").alias("official_name"), F.lit("").alias("coordinate"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def _keys(spark):
    return spark.range(5000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("project_key")).union(
        spark.createDataFrame([("HOT",)], "project_key string")
    )


SHUFFLED_AND_SKEWED = {
    "spark__sql__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": 2,
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
    "spark__sql__shuffle__partitions": 16,
}


def _lookups(spark, rows, keys):
    """Every operator that joins rows with a lookup, and a test that every row found its match."""
    cache = keys.withColumn("official_name", F.lit("name"))
    flagged = enrich.worklist(rows)
    # Lookups that come straight from a grouping are the hard case for the skew join.
    grouped = keys.groupBy("project_key").agg(F.max(F.lit("name")).alias("official_name"))
    edits = keys.select(F.col("project_key").alias("work_id"), F.lit(1).alias("seq"), F.lit("x").alias("new_tag"))
    markers = keys.select(F.col("project_key").alias("id"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng"))
    by_project = rows.withColumn("work_id", F.col("project_key"))
    gazetteer = keys.select(F.col("project_key").alias("municipality"), F.lit("p").alias("province"),
                            F.lit("r").alias("region"), F.lit(1).alias("rank"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng"))
    placed = flagged.withColumns({"municipalities": F.col("project_key"), "province": F.lit("p")})
    name, position = F.col("official_name") == "name", "1.000000, 2.000000"
    return {
        "safe_write": (enrich.safe_write(flagged, cache, ("official_name",)), name),
        "safe_write_grouped": (enrich.safe_write(flagged, grouped, ("official_name",)), name),
        "tag_denied": (denylist.tag_denied(rows, keys.select("*", F.lit("").alias("region"))), F.col("tag") == "Non interessa"),
        "tag_denied_region": (denylist.tag_denied(rows, keys.select("*", F.lit("R").alias("region"))), F.col("tag") == "Non interessa"),
        "apply_edits": (denylist.apply_edits(by_project, edits), F.col("tag") == "x"),
        "attach_marker": (shape.attach_marker(rows.withColumn("id", F.col("project_key")), markers, ["lat"]), F.col("lat") == 1.0),
        "fill_coordinates": (enrich.fill_coordinates(placed, gazetteer), F.col("coordinate") == position),
        "selected_rows": (views.selected_rows(rows, keys, "project_key"), F.lit(True)),
    }


NAMES = ("safe_write", "safe_write_grouped", "tag_denied", "tag_denied_region", "apply_edits",
         "attach_marker", "fill_coordinates", "selected_rows")


@pytest.mark.parametrize("name", NAMES)
def test_hot_project_is_split_in_lookup_joins(spark, name):
    with settings(spark, **SHUFFLED_AND_SKEWED):
        df, found = _lookups(spark, _big(spark), _keys(spark))[name]
        shown = df.select("work_id", "payload", found.alias("found"))
        assert shown.toArrow().filter(pc.field("found")).num_rows == ROWS
        assert "skew=true" in plan_of(shown)
