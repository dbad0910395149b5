"""Fields of landed works that no column takes."""

import json

import pytest
from pyspark.sql import functions as F
from test_jobs import at
from test_plans import plan_of

from snaptrack.plans.state import State, drop_expired_runs, refresh
from snaptrack.sources import landing

LINES = [
    {"id": 1, "importo_lav_totale": "23.532.434,20", "lotto": 7, "ente": {"nome": "A", "codici": [1, 2]}},
    {"id": "2", "importo_lav_totale": "30.000.000", "lotto": "B", "nulla": None, "a.b c": True},
    {"id": 3, "importo_lav_totale": 5, "lotto": 1},
    {"id": 4, "importo_lav_totale": "40.000.000", "strade_list": [{"CODICE_STRADA": "SS1", "DALKM": "1.5"}], "lat": 1.50},
]


def land(folder, name="PUGLIA.json", multiline=False, lines=LINES, broken=()):
    folder.mkdir(exist_ok=True)
    texts = [*map(json.dumps, lines), *broken]
    (folder / name).write_text("[" + ",\n".join(texts) + "]" if multiline else "\n".join(["", *texts, "  "]), encoding="utf-8")
    return str(folder)


@pytest.mark.parametrize("multiline", [False, True])
def test_columns_are_those_of_the_closed_scan(spark, tmp_path, multiline):
    path = land(tmp_path / "in", multiline=multiline, broken=() if multiline else ("not json", "[1]", '{"id": 9'))
    closed, opened = landing.scan_works(spark, path, multiline), landing.scan_works_open(spark, path, multiline)
    assert [c for c in opened.columns if c != "_unknown"] == closed.columns
    assert sorted(map(str, opened.select(closed.columns).collect())) == sorted(map(str, closed.collect()))
    got = {r.id: r.u for r in opened.select("id", F.to_json("_unknown").alias("u")).where("id is not null").collect()}
    assert {k: v and json.loads(v) for k, v in got.items() if k != "9"} == {
        "1": {"lotto": 7, "ente": {"nome": "A", "codici": [1, 2]}}, "2": {"lotto": "B", "nulla": None, "a.b c": True},
        "3": {"lotto": 1}, "4": None}


def test_drift_by_region(spark, tmp_path):
    path = land(tmp_path / "in")
    land(tmp_path / "in", "SICILIA.json", lines=[{"id": 5, "lotto": 1}, {"id": 6}])
    got = {(r._regione, r.field): (r.kind, r.rows) for r in landing.drift(landing.scan_works_open(spark, path)).collect()}
    assert got == {("Puglia", "lotto"): ("VARIANT", 3), ("Puglia", "ente"): ("OBJECT<codici: ARRAY<BIGINT>, nome: STRING>", 1),
                   ("Puglia", "nulla"): ("VOID", 1), ("Puglia", "a.b c"): ("BOOLEAN", 1), ("Sicilia", "lotto"): ("BIGINT", 1)}


def test_a_new_field_shows_in_the_run_and_can_be_projected_later(spark, tmp_path):
    state = State(spark, str(tmp_path / "state"))
    known = land(tmp_path / "known", lines=[{"id": 1, "importo_lav_totale": "23.532.434,20"}])
    grown = land(tmp_path / "grown", lines=[*LINES[:1], *LINES[2:]], broken=["not json"])
    one, two = at("2024-01-01 12:00"), at("2024-02-01 12:00")
    refresh(state, landing.scan_works_open(spark, known), one)
    refresh(state, landing.scan_works_open(spark, grown), two)
    runs = {r.run_ts: r for r in state.runs().collect()}
    assert runs[one].unknown_fields is None and runs[one].unknown is None and state.unknown(one).count() == 0
    # The work below the minimum is not in the run, so its fields are not either.
    assert runs[two].unknown_fields == "OBJECT<ente: OBJECT<codici: ARRAY<BIGINT>, nome: STRING>, lotto: BIGINT>"
    assert runs[two].corrupt_rows == 1 and runs[two].kept_rows == 2
    rows = state.unknown(two).select("work_id", "region", F.variant_get("fields", "$.ente.codici[1]", "int").alias("c")).collect()
    assert [tuple(r) for r in rows] == [("1", "Puglia", 2)]
    closed = State(spark, str(tmp_path / "closed"))
    for path, run in ((known, one), (grown, two)):
        refresh(closed, landing.scan_works(spark, path), run)
    for table in ("labelled", "history"):
        assert sorted(map(str, getattr(closed, table)().collect())) == sorted(map(str, getattr(state, table)().collect()))
    refresh(state, landing.scan_works_open(spark, known), at("2024-03-01 12:00"))
    drop_expired_runs(state, keep=1)
    assert state.unknown(two).count() == 0


def test_text_is_read_once(spark, tmp_path):
    works = landing.scan_works_open(spark, land(tmp_path / "in"))
    assert plan_of(works).count("FileScan") == 1
    none = landing.scan_works_open(spark, land(tmp_path / "none", lines=[]))
    assert none.count() == 0 and landing.drift(none).count() == 0
