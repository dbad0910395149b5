"""Rows shuffled as one text: nothing lost, the same order, and plans that shuffle no loose columns."""

import gzip
import itertools
import random

from pyspark.sql import functions as F

from snaptrack.operators import dedupe, packing, quarantine
from snaptrack.operators import intervals as I
from snaptrack.operators import reconcile as R
from snaptrack.plans import queries_works
from snaptrack.plans.master import import_master
from snaptrack.plans.state import State
from snaptrack.sources import landing

COLUMNS = ["a", "b", "c", "d", "e"]
TEXTS = [None, "", "\x00", "\x01", "\x01\x02", "\x01\x03", "\x02", "\x00\x01", " ", "a", "a b", "ä,\"\n", "a\x00", "a\x01"]


def some_rows(n=400):
    r = random.Random(7)
    return [*itertools.product(TEXTS[:4], TEXTS[:4], [None], [""], [None]), *[tuple(r.choice(TEXTS) for _ in COLUMNS) for _ in range(n)]]


def in_order(row):
    return tuple((v is not None, (v or "").encode()) for v in row)


def test_packed_rows_come_back_and_sort_as_their_columns(spark):
    rows = some_rows()
    packed = spark.createDataFrame(rows, "a string, b string, c string, d string, e string").select(packing.pack(COLUMNS).alias("p"))
    back = packing.with_unpacked(packed.orderBy("p"), "p", COLUMNS, "x_")
    assert back.columns == [f"x_{c}" for c in COLUMNS]
    assert [tuple(r) for r in back.collect()] == sorted(rows, key=in_order)
    assert packed.distinct().count() == len(set(rows))
    assert spark.sql("SELECT CAST(NULL AS STRING) AS p").select(packing.unpack(F.col("p")).alias("t")).first().t is None


def test_keep_first_and_last_of_odd_texts(spark):
    rows = [(i % 9, *row) for i, row in enumerate(some_rows())]
    df = spark.createDataFrame(rows, "k long, a string, b string, c string, d string, e string")
    key = lambda r: in_order((r[3], r[1], r[2], r[4], r[5]))
    for keep, pick in ((dedupe.keep_first, min), (dedupe.keep_last, max)):
        wanted = {pick((r for r in rows if r[0] == k), key=key) for k in range(9)}
        assert {tuple(r) for r in keep(df, ["k"], ["c"]).collect()} == wanted


def works(spark, n):
    rows = [(str(i % 7), f" P{i % 7}", f"r{i}", None if i % 3 else "", "x\x00", "y", "z") for i in range(n)]
    return spark.createDataFrame(rows, "work_id string, project_key string, road_code string, region string, one string, two string, three string")


def test_one_row_per_work_as_the_signature_were_part_of_the_row(spark):
    df = works(spark, 40)
    new, old = R.one_row_per_work(df), R.one_row_per_work(R.with_signature(df))
    assert new.columns == old.columns
    assert sorted(map(str, new.collect())) == sorted(map(str, old.collect()))


def test_whole_rows_match_as_their_columns_do(spark):
    one, two = R.one_row_per_work(works(spark, 40)), R.one_row_per_work(works(spark, 5).withColumn("two", F.lit("\x01")))
    loose, whole = R.match(one, two), R.match(one, two, whole=True)
    assert whole.select(*loose.columns).schema == loose.schema
    assert sorted(map(str, whole.select(*loose.columns).collect())) == sorted(map(str, loose.collect()))


def test_stretches_and_set_aside_rows_of_odd_texts(spark):
    rows = [(k, f"2024-01-0{d}", *([None, "", "\x00", "a"][(k + d // 3) % 4],) * 5) for k in range(4) for d in range(1, 8)]
    df = spark.createDataFrame(rows, "k long, run string, a string, b string, c string, d string, e string")
    history = df.withColumn("run_ts", F.col("run").cast("timestamp")).drop("run")
    stretches = I.encode(history, ["k"])
    assert stretches.count() == 12
    back = I.decode(stretches, history)
    assert sorted(map(str, back.select(*history.columns).collect())) == sorted(map(str, history.collect()))

    landed = works(spark, 40)
    found = quarantine.sort_out(landed, [], F.col("work_id"), ["road_code"])
    assert sorted(map(str, found.drop(quarantine.REASONS).collect())) == sorted(map(str, landed.collect()))
    kept = found.where(F.size(quarantine.REASONS) == 0).drop(quarantine.REASONS)
    assert sorted(map(str, kept.collect())) == sorted(map(str, dedupe.keep_first(landed, ["work_id"], ["road_code"]).select(*landed.columns).collect()))


def test_whole_rows_are_shuffled_packed(spark):
    one, two = R.one_row_per_work(works(spark, 40)), R.one_row_per_work(works(spark, 5))
    kept = one._jdf.queryExecution().optimizedPlan().toString()
    assert "min(CASE WHEN" in kept and "min(struct" not in kept
    joined = R.match(one, two, whole=True)._jdf.queryExecution().optimizedPlan().toString().split("Join FullOuter")[1]
    assert "AS new_three" not in joined and "AS old_three" not in joined


def test_set_aside_rows_are_ranked_packed(spark):
    plan = quarantine.sort_out(works(spark, 40), [], F.col("work_id"), ["road_code"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_row#") and all("three#" not in line for line in plan.splitlines() if "Window" in line)


def test_a_master_is_worked_through_once(spark, tmp_path):
    count = spark.sparkContext.accumulator(0)

    def seen(name):
        count.add(1)
        return name

    rows = [(str(i), "P1", "Lazio", f"C{i}", "10,0", "20,0") for i in range(30)]
    columns = ["work_id", "project_key", "region", "contractor", "Avanz_01-04-2024", "Avanz_01-05-2024_1200"]
    master = spark.createDataFrame(rows, columns).withColumn("contractor", F.udf(seen, "string").asNondeterministic()("contractor"))
    state = State(spark, str(tmp_path / "state"))
    import_master(state, master)
    assert count.value == len(rows)
    assert {r.contractor for r in state.entities().collect()} == {r[3] for r in rows}
    assert not (tmp_path / "state" / "import" / "sequence=1").exists()


def test_a_compressed_file_names_its_region(spark, tmp_path):
    with gzip.open(tmp_path / "PUGLIA.json.gz", "wt") as f:
        f.write('{"id": "1"}\n')
    assert [(r.id, r._regione) for r in landing.scan_works(spark, str(tmp_path)).collect()] == [("1", "Puglia")]


def test_a_dump_lands_as_few_files_for_the_stream(spark, monkeypatch, tmp_path):
    folders = []
    tables = {
        "nation": "0 n_nationkey, 'ITALY' n_name, 0 n_regionkey",
        "customer": "id c_custkey, 'c' c_name, 0 c_nationkey, 1D c_acctbal, 'AUTO' c_mktsegment",
        "orders": "id o_orderkey, id o_custkey, 'O' o_orderstatus, 9.5D o_totalprice, timestamp'2024-01-01' o_orderdate, '2-HIGH' o_orderpriority",
        "lineitem": "id l_orderkey, id l_partkey, id l_suppkey, 1 l_linenumber, 2D l_quantity, 3.5D l_extendedprice, 0D l_discount, 0D l_tax,"
                    " 'N' l_returnflag, if(id % 2 = 0, 'O', 'F') l_linestatus, timestamp'2024-01-01' l_shipdate",
    }
    for name, columns in tables.items():
        rows = spark.sql(f"SELECT {columns} FROM range({1 if name == 'nation' else 400})")
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(queries_works, "stream_into_state", lambda state, folder, *a, **k: folders.append(folder))
    monkeypatch.setattr(State, "labelled", lambda self: spark.createDataFrame([], "sig_project string, sig_region string, sig_id string, status string, label string"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        queries_works.stream_into_state_query(spark, str(tmp_path))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    landed = spark.read.parquet(folders[0])
    assert landed.count() == 400 and len(landed.inputFiles()) <= 2 * queries_works.LANDED_FILES
