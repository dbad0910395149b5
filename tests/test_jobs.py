"""Whole jobs: folding runs into state, files, streaming."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snaptrack.operators import history, views
from snaptrack.operators import reconcile as R
from snaptrack.operators.lifecycle import label_history
from snaptrack.operators.shape import align_schema, as_text, project_snapshot
from snaptrack.plans.catalog import QUERIES
from snaptrack.plans.state import (
    State, drop_expired_runs, drop_expired_versions, enrich, ingest_run, rebuild_entities, refresh, save_tags,
)
from snaptrack.schemas import ENTITY_COLUMNS, MERGE_COLUMNS, RAW_WORK, SNAPSHOT_COLUMNS
from snaptrack.sources import documents, landing, snapshots
from snaptrack.streaming.ingest import current_history, read_log, stream_into_state, stream_to_log


def snapshot(spark, works):
    """works: (id, region, project, road, contractor, progress)"""
    kind = ", ".join(f"{c} string" for c in ("work_id", "region", "project_key", "road_code", "contractor", "progress"))
    return align_schema(spark.createDataFrame(works, kind), SNAPSHOT_COLUMNS).select(*SNAPSHOT_COLUMNS)


def at(text):
    return datetime.fromisoformat(text)


DAY_1 = [("1", "Sicilia", "C1", "S1", "A", "10"), ("2", "Sicilia", "C2", "S1", "A", "95,17"),
         ("1", "Sicilia", "C1", "S0", "first road", "20"), ("3", "Puglia", "C3", "S1", "", "5")]
DAY_2 = [("1", "SICILIA", "C1", "S0", "", "22,5"), ("3", "Puglia", "C3", "S1", "B", "5"), ("4", "Puglia", "C4", "S1", "", "1")]


def labels(state):
    return {r.sig_id: r.label for r in state.labelled().collect()}


def test_fold_runs_into_state(spark, tmp_path):
    state = State(spark, str(tmp_path))
    ingest_run(state, snapshot(spark, DAY_1), at("2024-01-01 12:00"))
    assert labels(state) == {k: "Obra Nueva" for k in "123"}
    entries = spark.createDataFrame([("C3", "puglia")], "project_key string, region string")
    ingest_run(state, snapshot(spark, DAY_2), at("2024-02-01 12:00"), entries)
    assert labels(state) == {"1": "+2.5%", "2": "Obra Conclusa (probable)", "3": "0%", "4": "Obra Nueva"}
    kept = {r.work_id: (r.contractor, r.region, r.tag) for r in state.entities().collect()}
    assert kept == {"1": ("first road", "SICILIA", ""), "2": ("A", "Sicilia", ""),
                    "3": ("B", "Puglia", "Non interessa"), "4": ("", "Puglia", "")}
    wide = state.wide()
    assert wide.columns[-2:] == ["Avanz_01-01-2024_1200", "Avanz_01-02-2024_1200"]
    # A re-run of the same day replaces the run; the work first seen that morning is no longer new.
    ingest_run(state, snapshot(spark, DAY_2[:2] + DAY_1[3:4]), at("2024-02-01 15:00"))
    assert labels(state) == {"1": "+2.5%", "2": "Obra Conclusa (probable)", "3": "0%", "4": "Obra Desaparecida"}


def test_same_batch_twice_changes_nothing(spark, tmp_path):
    state = State(spark, str(tmp_path))
    for _ in range(2):
        ingest_run(state, snapshot(spark, DAY_1), at("2024-01-01 12:00"))
    assert state.runs().count() == 1 and state.head().sequence == 2
    assert labels(state) == {k: "Obra Nueva" for k in "123"}
    assert state.entities().count() == 3


def test_late_run_fills_gaps_and_takes_its_place_in_time(spark, tmp_path):
    state = State(spark, str(tmp_path))
    ingest_run(state, snapshot(spark, DAY_2), at("2024-02-01 12:00"))
    ingest_run(state, snapshot(spark, DAY_1), at("2024-01-01 12:00"))
    assert labels(state) == {"1": "+2.5%", "2": "Obra Conclusa (probable)", "3": "0%", "4": "Obra Nueva"}
    kept = {r.work_id: (r.contractor, r.region) for r in state.entities().collect()}
    assert kept["1"] == ("first road", "SICILIA") and kept["3"] == ("B", "Puglia")


def test_unusable_snapshot_leaves_the_state_alone(spark, tmp_path):
    state = State(spark, str(tmp_path))
    with pytest.raises(ValueError):
        ingest_run(state, snapshot(spark, DAY_1).where("false"), at("2024-01-01 12:00"))
    with pytest.raises(ValueError):
        ingest_run(state, snapshot(spark, DAY_1).drop("work_id"), at("2024-01-01 12:00"))
    assert state.head().sequence == 0 and state.newest_run() is None and state.entities().count() == 0


def test_half_written_ingest_is_invisible(spark, tmp_path):
    state = State(spark, str(tmp_path))
    ingest_run(state, snapshot(spark, DAY_1), at("2024-01-01 12:00"))
    # Files of a run that never committed.
    later = at("2024-02-01 12:00")
    batch = R.one_row_per_work(as_text(align_schema(snapshot(spark, DAY_2), [*ENTITY_COLUMNS])))
    batch.withColumn("run_ts", F.lit(later)).write.parquet(state.folder("snapshots", 2))
    state.entities().limit(0).write.parquet(state.folder("entities", 2))
    assert labels(state) == {k: "Obra Nueva" for k in "123"} and state.entities().count() == 3
    ingest_run(state, snapshot(spark, DAY_2), later)
    assert labels(state)["1"] == "+2.5%"


def test_refresh_from_raw_works(spark, tmp_path):
    works = [("1", "Sicilia", "23.532.434,20"), ("2", "Sicilia", "9.999.999,99"), ("3", "Lazio", "50.000.000,00"),
             ("4", "Puglia", "1E7"), ("5", "Puglia", None)]
    rows = spark.createDataFrame(works, "id string, _regione string, importo_lav_totale string")
    others = [f for f in RAW_WORK.fields if f.name not in rows.columns]
    raw = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in others],
                      F.lit(at("2023-12-31 08:00")).alias("updated_at"))
    state = State(spark, str(tmp_path))
    refresh(state, raw, at("2024-01-01 12:00"))
    assert sorted((r.work_id, r.amount_total) for r in state.entities().collect()) == [
        ("1", "23532434.2"), ("4", "10000000.0")
    ]
    run = state.runs().first()
    assert (run.total_rows, run.kept_rows, run.updated_at) == (4, 2, at("2023-12-31 08:00"))


def test_expired_versions(spark, tmp_path):
    state = State(spark, str(tmp_path))
    for day in range(1, 5):
        ingest_run(state, snapshot(spark, DAY_1), at(f"2024-01-0{day} 12:00"))
    assert drop_expired_versions(state, keep=4) == 0
    assert drop_expired_versions(state, keep=2) == 4  # two of the entities, two of the facts
    assert not (tmp_path / "entities/sequence=2").exists() and state.entities().count() == 3
    assert drop_expired_versions(state, keep=2) == 0
    assert drop_expired_runs(state, keep=3) == 1 and not (tmp_path / "snapshots/sequence=1").exists()
    assert labels(state) == {k: v for k, v in zip("123", ["0%"] * 3, strict=True)}


def _random_runs(seed, runs=5):
    rng = random.Random(seed)
    for r in range(runs):
        works = []
        for i in range(12):
            if rng.random() < 0.7:
                works.append((str(i), rng.choice(["A", "a ", "A"]), f"C{i}", "S", rng.choice(["", "nan", f"v{r}"]),
                              rng.choice(["", "5", "80", "100", f"{rng.randrange(100)},{rng.randrange(10)}"])))
        yield datetime(2024, 1, 1 + r // 2, 8 + r), works


def test_folding_equals_rebuilding(spark, tmp_path):
    for seed in (1, 2):
        state = State(spark, str(tmp_path / str(seed)))
        for run_ts, works in _random_runs(seed):
            ingest_run(state, snapshot(spark, works), run_ts)
        columns = [*R.SIGNATURE, "work_id", *MERGE_COLUMNS]
        folded = sorted(map(tuple, state.entities().select(*columns).collect()))
        assert folded == sorted(map(tuple, rebuild_entities(state.log()).select(*columns).collect()))
        assert len(folded) == len({f[:3] for f in folded})


def test_landed_json_arrays_and_lines(spark, tmp_path):
    (tmp_path / "PUGLIA.json").write_text(
        '[{"id": 7, "cup": " F1 ", "descrizione": "a\\n\\tb", "importo_lav_totale": "23.532.434,20",'
        ' "strade_list": [{"CODICE_STRADA": "SS1", "DALKM": "1.5", "ALKM": "2"}], "lat": 1.5, "lng": 2.0},'
        '\n {"id": 8, "_regione": "Puglia", "importo_lav_totale": "x"}]', encoding="utf-8")
    works = landing.scan_works(spark, str(tmp_path), multiline=True)
    assert sorted(works.schema.names) == sorted([*RAW_WORK.names, "_corrupt", "updated_at"])
    assert works.where("updated_at is null").count() == 0
    got = {r.work_id: r for r in project_snapshot(works).collect()}
    assert (got["7"].region, got["7"].project_key, got["7"].description) == ("Puglia", "F1", "a b")
    assert (got["7"].amount_total, got["7"].segments) == (23532434.2, "SS1 1.5–2")
    assert got["7"].coordinate == "1.500000, 2.000000"
    assert (got["8"].region, got["8"].amount_total, got["8"].segments) == ("Puglia", None, "")


def test_roads_markers_and_pages(spark, tmp_path):
    (tmp_path / "roads.json").write_text('[{"codice": "SS1", "strada": "Road one"}]')
    (tmp_path / "markers.json").write_text('{"id": 7, "lat": 1.5, "lng": null}\n{"id": "8"}')
    (tmp_path / "F1.html").write_text("<p>a\nb</p>")
    assert landing.scan_roads(spark, str(tmp_path / "roads.json"), multiline=True).first() == ("SS1", "Road one")
    markers = landing.scan_markers(spark, str(tmp_path / "markers.json")).collect()
    assert sorted(map(tuple, markers)) == [("7", 1.5, None), ("8", None, None)]
    assert landing.scan_pages(spark, str(tmp_path / "*.html")).first() == ("F1", "<p>a\nb</p>")


def test_csv_has_a_byte_order_mark_and_survives(spark, tmp_path):
    folder = str(tmp_path / "out")
    snap = snapshot(spark, [("1", 'q"uo,te', "C1", "two\nlines", " pad ", "")])
    snapshots.write_csv(snap, folder)
    file = next(p for p in (tmp_path / "out").iterdir() if p.suffix == ".csv")
    assert file.read_bytes().startswith(b"\xef\xbb\xbfwork_id,")
    assert list(map(tuple, snapshots.scan_csv(spark, folder).collect())) == list(map(tuple, snap.collect()))


def test_newest_usable_file(spark, tmp_path):
    for name, size in (("works_20240101_120000.csv", 80), ("works_20240201_120000.csv", 80), ("works_20240301_120000.csv", 3)):
        (tmp_path / name).write_text("x" * size)
    assert snapshots.newest_usable_file(spark, str(tmp_path)).first().path.endswith("20240301_120000.csv")
    newest = snapshots.newest_usable_file(spark, str(tmp_path), min_bytes=50).first()
    assert newest.path.endswith("works_20240201_120000.csv") and newest.run_ts == at("2024-02-01 12:00")


def test_write_run_replaces_only_its_own_run(spark, tmp_path):
    table = str(tmp_path / "runs")
    for run, value in (("a", 1), ("b", 2), ("a", 3)):
        rows = spark.createDataFrame([(value, "2024-01-01", run)], "v int, run_date string, run_ts string")
        snapshots.write_run(rows, table)
    assert sorted((r.run_ts, r.v) for r in spark.read.parquet(table).collect()) == [("a", 3), ("b", 2)]


def test_deny_list_files(spark, tmp_path):
    shapes = {
        "entries": '{"entries": [\n  {"cup": "C1",\n   "regione": "Sicilia"}, {"regione": "x"}],\n "cups": ["no"]}',
        "cups": '{"cups": [" C2 ", "  "]}', "ids": '{"cups": [], "ids": ["3"]}', "none": '{"entries": [], "ids": ["no"]}',
    }
    for name, body in shapes.items():
        (tmp_path / f"{name}.json").write_text(body)
    read = documents.scan_denylist(spark, str(tmp_path))
    assert sorted(r.project_key for r in read.collect()) == ["3", "C1", "C2"]
    stored = str(tmp_path / "stored")
    documents.write_denylist(read, stored)
    assert sorted(map(tuple, documents.scan_denylist_lines(spark, stored).collect())) == sorted(map(tuple, read.collect()))


def test_cache_document(spark, tmp_path):
    (tmp_path / "cache.json").write_text('{"C1": {"Provincia": "CT",\n "Cup_Padre": ""},\n "C2": {"Settore": "s"}}')
    cache = documents.scan_cache(spark, str(tmp_path))
    assert sorted((r.project_key, r.province, r.sector) for r in cache.collect()) == [("C1", "CT", ""), ("C2", "", "s")]


def _land(spark, folder, rows, name):
    df = spark.createDataFrame(rows, "k string, run_ts timestamp, pct_text string").coalesce(1)
    df.write.parquet(f"{folder}/{name}")
    return df


def test_stream_settles_reruns_late_and_split_runs(spark, tmp_path):
    landing_dir, state = str(tmp_path / "in"), str(tmp_path / "state")
    parts = [
        [("a", at("2024-01-02 08:00"), "5"), ("a", at("2024-01-02 08:00"), "5"), ("b", at("2024-01-02 08:00"), "90")],
        [("a", at("2024-01-02 09:00"), "6")],
        [("a", at("2024-01-01 09:00"), "1"), ("b", at("2024-01-01 09:00"), "85")],
        [("c", at("2024-01-02 09:00"), "7")],
    ]
    schema, everything = None, None
    for i, rows in enumerate(parts):
        df = _land(spark, landing_dir, rows, f"part{i}")
        everything = df if everything is None else everything.unionByName(df)
        schema = df.schema
        stream_to_log(spark, f"{landing_dir}/*", state, schema, ["k"], ["pct_text"])
    # Nothing new has landed: a further call adds nothing.
    stream_to_log(spark, f"{landing_dir}/*", state, schema, ["k"], ["pct_text"])
    got = sorted((r.k, r.run_ts, r.pct_text) for r in current_history(spark, state, ["k"], ["pct_text"]).collect())
    assert got == [("a", at("2024-01-01 09:00"), "1"), ("a", at("2024-01-02 09:00"), "6"),
                   ("b", at("2024-01-01 09:00"), "85"), ("c", at("2024-01-02 09:00"), "7")]
    pct = F.expr("try_cast(pct_text as double)")
    streamed = label_history(read_log(spark, state, ["k"], ["pct_text"]).withColumn("pct", pct), ["k"])
    batch = label_history(everything.distinct().withColumn("pct", pct), ["k"])
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert {r.k: r.label for r in streamed.collect()} == {"a": "+5.0%", "b": "Obra Conclusa (probable)", "c": "Obra Nueva"}


def test_columns_line_up():
    assert len(SNAPSHOT_COLUMNS) == 27 and len(ENTITY_COLUMNS) == 27 and len(MERGE_COLUMNS) == 25
    assert date(2024, 1, 1)  # the fixtures above use fixed dates only


WRITES = ("snapshots", "entities", "facts", "commits")


@pytest.mark.parametrize("dies_at", WRITES)
def test_a_job_that_dies_changes_nothing_readers_see(spark, tmp_path, monkeypatch, dies_at):
    state = State(spark, str(tmp_path))
    ingest_run(state, snapshot(spark, DAY_1), at("2024-01-01 12:00"))
    ingest_run(state, snapshot(spark, DAY_2), at("2024-02-01 12:00"))

    def seen():
        return (sorted(map(str, state.labelled().collect())), sorted(map(str, state.wide().collect())),
                sorted(map(str, state.log().collect())), sorted(map(str, state.runs().collect())))

    before = seen()
    real = State.folder

    def dying(self, table, sequence):
        if table == dies_at and sequence == 3:
            raise RuntimeError("lost")
        return real(self, table, sequence)

    monkeypatch.setattr(State, "folder", dying)
    changed = [(*w[:5], "99") for w in DAY_2]
    for run in ("2024-02-01 12:00", "2024-01-15 12:00", "2024-03-01 12:00"):
        with pytest.raises(RuntimeError):
            ingest_run(state, snapshot(spark, changed), at(run))
        monkeypatch.setattr(State, "folder", real)
        assert seen() == before
        monkeypatch.setattr(State, "folder", dying)


def test_facts_are_those_of_the_whole_history(spark, tmp_path):
    for seed in (3, 4):
        state = State(spark, str(tmp_path / str(seed)))
        runs = list(_random_runs(seed, 6))
        for k in (0, 1, 4, 2, 5, 3):  # late runs and runs of one day among them
            ingest_run(state, snapshot(spark, runs[k][1]), runs[k][0])
        whole = label_history(state.observations(), R.SIGNATURE)
        own = state.labelled().select(whole.columns)
        assert sorted(map(str, own.collect())) == sorted(map(str, whole.collect()))


def test_labels_and_shown_runs_read_only_what_they_need(spark, tmp_path):
    state = State(spark, str(tmp_path))
    for day in range(1, 6):
        ingest_run(state, snapshot(spark, DAY_1), at(f"2024-01-0{day} 12:00"))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "/snapshots" not in plan(state.labelled())
    scans = [line for line in plan(state.wide(3)).splitlines() if "FileScan" in line and "sequence#" in line]
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]*sequence", line) for line in scans), scans


def test_tags_are_stored(spark, tmp_path):
    state = State(spark, str(tmp_path))
    ingest_run(state, snapshot(spark, DAY_1), at("2024-01-01 12:00"))
    kind = "work_id string, seq int, new_tag string"
    first = spark.createDataFrame([("1", 1, "Da caricare"), ("1", 2, "Non interessa"), ("2", 1, "In VTiger")], kind)
    assert save_tags(state, first, date(2024, 1, 2)) == {"added": 1, "removed": 0}
    tags = {r.work_id: r.tag for r in state.entities().collect()}
    assert tags == {"1": "Non interessa", "2": "In VTiger", "3": ""}
    assert [(r.project_key, r.region) for r in state.entries().collect()] == [("C1", "Sicilia")]
    # The list is remembered by the next run, and a tag taken back removes the entry.
    new = [("9", "SICILIA", "C1", "S1", "", "")]
    ingest_run(state, snapshot(spark, DAY_2 + new), at("2024-02-01 12:00"))
    assert {r.work_id: r.tag for r in state.entities().collect()}["9"] == "Non interessa"
    back = spark.createDataFrame([("1", 1, "")], kind)
    assert save_tags(state, back, date(2024, 2, 2)) == {"added": 0, "removed": 1}
    assert state.entries().count() == 0


PAGE = "<p>Dettaglio Progetto</p><p>A long official name</p><p>Provincia</p><p>CT</p><p>Comune</p><p>Town; x</p>"


def test_enrichment_is_stored_for_requested_projects_only(spark, tmp_path):
    state = State(spark, str(tmp_path))
    ingest_run(state, snapshot(spark, DAY_1), at("2024-01-01 12:00"))
    pages = spark.createDataFrame([("C1", PAGE), ("C2", PAGE), ("C3", "<p>nothing</p>")], "project_key string, html string")
    places = spark.createDataFrame([("Town", "CT", "Sicilia", 1, 1.0, 2.0)],
                                   "municipality string, province string, region string, rank int, lat double, lng double")
    keys = spark.createDataFrame([("C1",), ("C3",)], "project_key string")
    got = enrich(state, pages, places, keys)
    assert got == {"rows_touched": 2, "rows_need_record": 2, "rows_need_coordinate": 2, "rows_complete": 0,
                   "fields_written": 3, "rows_written": 1, "coordinates_found": 1}
    rows = {r.work_id: (r.official_name, r.province, r.coordinate) for r in state.entities().collect()}
    assert rows == {"1": ("A long official name", "CT", "1.000000, 2.000000"), "2": ("", "", ""), "3": ("", "", "")}
    assert [r.project_key for r in state.cache().collect()] == ["C1"]
    assert labels(state) == {k: "Obra Nueva" for k in "123"}
    again = enrich(state, pages.limit(0), places, keys)
    assert again["rows_complete"] == 1 and again["fields_written"] == 0


def test_csv_goes_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿Regione,extra,Id_ANAS,Cup\nSicilia,x,7,C1\n", encoding="utf-8")
    row = snapshots.scan_csv(spark, str(tmp_path / "a.csv")).first()
    assert (row.work_id, row.region, row.project_key, row.contractor) == ("7", "Sicilia", "C1", "")
    assert row.__fields__ == list(SNAPSHOT_COLUMNS)
    (tmp_path / "b.csv").write_text("Regione,other\nSicilia,7\n", encoding="utf-8")
    with pytest.raises(ValueError):
        snapshots.scan_csv(spark, str(tmp_path / "b.csv"))


def test_refresh_keeps_regions_of_file_names_and_counts_broken_lines(spark, tmp_path):
    (tmp_path / "PUGLIA.json").write_text(
        '{"id": 1, "importo_lav_totale": "23.532.434,20", "lat": "38.7", "lng": 9}\nnot json\n'
        '{"id": 2, "_regione": "Sicilia", "importo_lav_totale": 0}\n{"id": 3, "_regione": "Lazio"}\n', encoding="utf-8")
    state = State(spark, str(tmp_path / "state"))
    refresh(state, landing.scan_works(spark, str(tmp_path / "*.json")), at("2024-01-01 12:00"), minimum=0.0)
    run = state.runs().first()
    assert (run.total_rows, run.kept_rows, run.corrupt_rows) == (2, 2, 1)
    rows = {r.work_id: (r.region, r.amount_total, r.coordinate) for r in state.entities().collect()}
    assert rows == {"1": ("Puglia", "23532434.2", "38.700000, 9.000000"), "2": ("Sicilia", "", "")}


def test_stream_into_state_settles_late_repeated_and_empty(spark, tmp_path):
    landed, state = str(tmp_path / "in"), State(spark, str(tmp_path / "state"))
    schema = None
    for k, (run, works) in enumerate([("2024-02-01 12:00", DAY_2), ("2024-01-01 12:00", DAY_1), ("2024-02-01 12:00", DAY_2), (None, [])]):
        rows = snapshot(spark, works or DAY_1[:1]).withColumn("run_ts", F.lit(at(run or "2024-01-01 12:00")))
        rows = rows.where(F.lit(bool(works))).coalesce(1)
        schema = rows.schema
        rows.write.parquet(f"{landed}/part{k}")
        stream_into_state(state, f"{landed}/*", schema, files_per_batch=1)
    assert labels(state) == {"1": "+2.5%", "2": "Obra Conclusa (probable)", "3": "0%", "4": "Obra Nueva"}
    assert state.runs().count() == 2 and state.head().sequence == 3


@pytest.mark.parametrize("calls", [1, 3])
def test_stream_into_state_gathers_a_run_of_several_files(spark, tmp_path, calls):
    landed, state, whole = str(tmp_path / "in"), State(spark, str(tmp_path / "state")), State(spark, str(tmp_path / "whole"))
    # The parts of the runs land in turn; a work has rows in two parts of a run.
    parts = [("2024-02-01 12:00", DAY_2[:1]), ("2024-01-01 12:00", DAY_1[2:]), ("2024-02-01 12:00", DAY_2[1:2]),
             ("2024-01-01 12:00", DAY_1[:1]), ("2024-01-01 12:00", DAY_1[1:2]), ("2024-02-01 12:00", DAY_2[2:])]
    for k, (run, works) in enumerate(parts):
        rows = snapshot(spark, works).withColumn("run_ts", F.lit(at(run))).coalesce(1)
        rows.write.parquet(f"{landed}/part{k}")
        if (k + 1) % (len(parts) // calls) == 0:
            stream_into_state(state, f"{landed}/*", rows.schema, files_per_batch=1)
    stream_into_state(state, f"{landed}/*", rows.schema, files_per_batch=1)
    ingest_run(whole, snapshot(spark, DAY_1), at("2024-01-01 12:00"))
    ingest_run(whole, snapshot(spark, DAY_2), at("2024-02-01 12:00"))
    for a, b in ((state.entities(), whole.entities()), (state.log(), whole.log()), (state.labelled(), whole.labelled())):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert state.runs().count() == 2 and state.head().sequence == {1: 2, 3: 6}[calls]


def test_runs_of_no_time_count_first():
    assert views.column_plan(
        type("df", (), {"columns": ["Avanz_01-07-2026_0900", "Avanz_x", "Avanz_01-06-2026", "Avanz_01-05-2026", "Avanz_2026-04-01"]}), [],
    ) == ["Avanz_01-05-2026", "Avanz_01-06-2026", "Avanz_01-07-2026_0900"]


def test_runs_of_no_time_are_kept(spark):
    rows = [("a", None, "90", 90.0), ("a", at("2024-01-01 08:00"), "", None), ("b", at("2024-01-01 09:00"), "1", 1.0)]
    df = spark.createDataFrame(rows, "k string, run_ts timestamp, pct_text string, pct double")
    assert sorted((r.k, r.run_ts) for r in history.same_day_replace(df).collect() if r.run_ts is None) == [("a", None)]
    assert history.same_day_replace(df).count() == 2
    assert [(r.run_ts, r.position) for r in history.run_calendar(df).orderBy("position").collect()] == [
        (None, 1), (at("2024-01-01 08:00"), 2), (at("2024-01-01 09:00"), 3)]
    assert {r.k: r.label for r in label_history(df, ["k"]).collect()} == {"a": "Obra Conclusa (probable)", "b": "Obra Nueva"}
    assert history.last_known(df, ["k"], F.lit(at("2024-01-01 09:00"))).first().last_known == 90.0


def test_history_of_any_number_of_runs(spark):
    runs = [datetime(2020, 1, 1 + k % 28, k // 28) for k in range(500)]
    df = spark.createDataFrame([("a", r, "1") for r in runs], "k string, run_ts timestamp, pct_text string")
    assert len(history.to_wide(df, ["k"], runs).columns) == 501


def test_wide_history_has_every_run_of_the_table(spark, tmp_path):
    days = [datetime(2023, 6, 1) + timedelta(days=k) for k in range(500)]
    rows = [(k, d + timedelta(hours=k % 24), k % 3, "view", float(5 + k % 90)) for k, d in enumerate(days)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    df.write.parquet(str(tmp_path / "all/events.parquet"))
    wide = QUERIES["history_pivot"](spark, str(tmp_path / "all"))
    assert wide.columns == ["user_id", "event_type", *(f"Avanz_{d:%d-%m-%Y}_0000" for d in days)]
    long = QUERIES["history_unpivot"](spark, str(tmp_path / "all")).collect()
    assert sorted((r.run, r.user_id, r.pct) for r in long) == [
        (f"{d:%Y-%m-%d} 00:00:00", k % 3, float(5 + k % 90)) for k, d in enumerate(days)]
    df.limit(0).write.parquet(str(tmp_path / "none/events.parquet"))
    assert QUERIES["history_unpivot"](spark, str(tmp_path / "none")).collect() == []
