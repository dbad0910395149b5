"""What only shows on large tables: code that gets compiled, shuffle files that go, files tasks can share, broadcasts."""

import contextlib
import io
import re
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from snaptrack.operators import enrich as E
from snaptrack.operators import packing
from snaptrack.plans import queries_works
from snaptrack.plans.state import Job, State, ingest_checked
from snaptrack.schemas import CACHE, ENTITIES, ENTITY_COLUMNS, RECORD_COLUMNS
from snaptrack.session import JOB_SETTINGS, job_settings

# Above this size the JVM does not compile a method.
COMPILED = 8000


def explained(df, mode):
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        df.explain(mode)
    return said.getvalue()


def texts(spark, n):
    return spark.range(n).select(*[F.concat(F.lit(f"{c} "), F.col("id")).alias(c) for c in ENTITY_COLUMNS])


def test_packing_wide_rows_is_compiled(spark):
    columns = list(ENTITY_COLUMNS)
    packed = texts(spark, 10).select(packing.pack(columns).alias("p"))
    back = packing.with_unpacked(packed, "p", columns)
    for df in (packed, back):
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", explained(df, "codegen"))]
        assert max(sizes, default=0) < COMPILED
    assert back.collect() == texts(spark, 10).collect()


def test_packed_rows_without_odd_texts_meet_no_lambda_and_odd_ones_come_back(spark):
    signs = [None, "", *[chr(i) for i in range(7)], "\x02\x03", "\x02\x05\x03", "\x02\x02", "a\x01b"]
    rows = [(a, b, "", None, a) for a in signs for b in signs]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string")
    packed = df.select(packing.pack(df.columns).alias("p"))
    back = packing.with_unpacked(packed.orderBy("p"), "p", df.columns)
    assert [tuple(r) for r in back.collect()] == sorted(rows, key=lambda r: tuple((v is not None, (v or "").encode()) for v in r))


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


def test_shuffle_files_go_with_the_write_they_served(spark, tmp_path):
    state = State(spark, str(tmp_path / "state"))
    rows = texts(spark, 500).withColumn("progress", F.lit("1,00"))
    before = shuffle_files(spark)
    ingest_checked(state, rows, queries_works.RUN_1, [])
    until = time.time() + 8
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    # Counts and run tables are collected, not written: theirs may stay for a while.
    assert sum(len(open(f, "rb").read()) for f in left if f.endswith(".data")) < 20_000
    assert state.entities().count() == 500


def test_a_session_has_its_own_settings_again_after_a_write(spark):
    names = [*JOB_SETTINGS, "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    with contextlib.suppress(ZeroDivisionError), job_settings(spark):
        assert all(spark.conf.get(n) == v for n, v in JOB_SETTINGS.items())
        raise ZeroDivisionError
    assert {n: spark.conf.get(n, None) for n in names} == before


def test_a_landed_file_is_shared_by_tasks(spark, tmp_path, monkeypatch):
    sql = {
        "nation": "id AS n_nationkey, 'Italy' AS n_name, id AS n_regionkey",
        "customer": "id AS c_custkey, 0L AS c_nationkey, 'MACHINERY' AS c_mktsegment",
        "orders": "id AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, 100.0D AS o_totalprice, TIMESTAMP '2024-01-01' AS o_orderdate, '5-LOW' AS o_orderpriority",
        "lineitem": "id AS l_orderkey, id AS l_suppkey, 1 AS l_linenumber, 5.0D AS l_quantity, 10.0D AS l_extendedprice, 0.1D AS l_discount, 0.1D AS l_tax, 'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP '2024-01-01' AS l_shipdate",
    }
    for name, columns in sql.items():
        spark.sql(f"SELECT {columns} FROM range({1 if name == 'nation' else 6000})").write.parquet(str(tmp_path / f"{name}.parquet"))
    folders = []
    monkeypatch.setattr(queries_works, "ROW_GROUP", 1 << 14)
    monkeypatch.setattr(queries_works, "stream_into_state", lambda state, folder, *a, **k: folders.append(folder))
    monkeypatch.setattr(State, "labelled", lambda self: spark.createDataFrame([], "sig_project string, sig_region string, sig_id string, status string, label string"))
    queries_works.stream_into_state_query(spark, str(tmp_path))
    landed = spark.read.parquet(folders[0])
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata.num_row_groups for f in landed.inputFiles()]
    assert landed.count() == 6000 and max(groups) > 1


def entities(spark, n):
    fixed = {"project_key": F.concat(F.lit(" C"), F.col("id") % 4), "coordinate": F.lit(""), "region": F.lit("Lazio")}
    return spark.range(n).select(*[fixed.get(c, F.lit("") if c in RECORD_COLUMNS else F.col("id").cast("string")).alias(c) for c in ENTITIES.names])


def test_the_cache_is_joined_once(spark):
    records = spark.range(3).select(F.concat(F.lit("C"), "id").alias("project_key"), *[
        F.when(F.col("id") > 0, F.concat(F.lit(f"{c} "), "id")).otherwise("").alias(c) for c in RECORD_COLUMNS])
    places = [("municipalities 1", "province 1", "lazio", 1, 41.0, 12.0), ("municipalities 2", "", "lazio", 2, 42.0, 13.0)]
    gazetteer = spark.createDataFrame(places, "municipality string, province string, region string, rank int, lat double, lng double")
    flagged = E.worklist(entities(spark, 12))
    once = E.fill_coordinates(E.safe_write(flagged, records.select(CACHE.names), place=True), gazetteer, records)
    twice = E.fill_coordinates(E.safe_write(flagged, records.select(CACHE.names)), gazetteer, records)
    assert once.columns == twice.columns
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.where("coordinate_found").count() == 6
    joins = [explained(df, "simple").count("Join") for df in (once, twice)]
    assert joins[0] < joins[1]


def test_a_small_file_of_many_rows_is_not_broadcast_unmeasured(spark, tmp_path):
    """Half a megabyte of file, 32 MB of rows."""
    path = str(tmp_path / "lookup")
    spark.range(400_000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("k"), F.lit("the same " * 4).alias("v")).write.option("compression", "zstd").parquet(path)
    rows = spark.range(2_000_000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("k"))
    job = Job(State(spark, str(tmp_path / "state")), "test")
    lookup = spark.read.parquet(path)
    with job_settings(spark):
        assert "BroadcastHashJoin" not in explained(E.lookup_join(rows, lookup, ["k"]), "simple")
    assert job.sequence == 1
