"""A state from an existing master, the deny-list by bare key, and the guard of known days."""

from datetime import date

import pytest
from test_jobs import DAY_1, DAY_2, at, labels, snapshot

from snaptrack.operators import denylist
from snaptrack.operators.shape import align_schema
from snaptrack.plans.master import import_master
from snaptrack.plans.state import State, deny_rows, drop_expired_runs, ingest_new_days, ingest_run, undeny
from snaptrack.schemas import CACHE

HEADERS = "Id_ANAS string, Regione string, Cup string, Codice_Strada string, Impresa string"


def master(spark, columns, rows):
    return spark.createDataFrame(rows, HEADERS + "".join(f", `{c}` string" for c in columns))


def test_a_master_begins_a_state(spark, tmp_path):
    runs = ["Avanz_01-12-2023", "Avanz_01-01-2024_1200"]
    rows = [
        (" 1", "Sicilia", "C1", "S0", "first road", "Non interessa", "10", "20", "+10.0%"),
        ("1 ", "Sicilia", "C9", "S1", "later road", "", "", "", ""),
        ("2", "Sicilia", "C2", "S1", "A", None, "95,17", "", "Obra Conclusa (probable)"),
        ("3", "Puglia", "C3", "S1", "", "Da caricare", "", "", ""),
        ("5", "Puglia", "C5", "S1", "", "", "", "", "Obra Desaparecida"),
    ]
    state = State(spark, str(tmp_path / "state"))
    entries = spark.createDataFrame([(" C4 ", "", "", "", "")], "project_key string, region string, contractor string, description string, added_on string")
    cache = spark.createDataFrame([("C1", "name")], "project_key string, official_name string")

    import_master(state, master(spark, ["Stato", *runs, "Differenza"], rows), entries, align_schema(cache, CACHE.names))
    assert {r.work_id: (r.tag, r.contractor) for r in state.entities().collect()} == {
        "1": ("Non interessa", "first road"), "2": ("", "A"), "3": ("Da caricare", ""), "5": ("", "")}
    assert labels(state) == {"1": "+10.0%", "2": "Obra Conclusa (probable)", "3": "", "5": "Obra Desaparecida"}
    assert state.runs().count() == 2 and state.newest_run() == at("2024-01-01 12:00")
    assert [(r.sig_id, r.pct_text) for r in state.observations().orderBy("run_ts", "sig_id").collect()] == [
        ("1", "10"), ("2", "95,17"), ("3", ""), ("5", ""), ("1", "20"), ("3", "")]
    assert state.cache().first().official_name == "name"
    # The next run goes on from there: nothing the master knew is new.
    ingest_run(state, snapshot(spark, DAY_2 + [("5", "Puglia", "C5", "S1", "", "7")]), at("2024-02-01 12:00"))
    assert labels(state) == {"1": "+2.5%", "2": "Obra Conclusa (probable)", "3": "", "4": "Obra Nueva", "5": ""}
    assert {r.work_id: r.tag for r in state.entities().collect()}["4"] == "Non interessa"
    # So do late runs and retention.
    ingest_run(state, snapshot(spark, DAY_1[:2]), at("2023-12-15 12:00"))
    before = labels(state)
    drop_expired_runs(state, keep=1)
    assert labels(state) == before and state.runs().count() == 4
    with pytest.raises(ValueError, match="begin"):
        import_master(state, master(spark, [], []))


def test_masters_of_one_run_or_none_or_nothing(spark, tmp_path):
    rows = [("1", "Sicilia", "C1", "S1", "A", " Si "), ("3", "Puglia", "C3", "S1", "B", "no")]
    one = State(spark, str(tmp_path / "one"))
    import_master(one, master(spark, ["VTiger", "Avanz_01-01-2024"], [(*rows[0], "10"), (*rows[1], "")]))
    none = State(spark, str(tmp_path / "none"))
    import_master(none, master(spark, ["VTiger"], rows))
    for state in (one, none):
        assert {r.work_id: r.tag for r in state.entities().collect()} == {"1": "In VTiger", "3": ""}
        ingest_run(state, snapshot(spark, DAY_2), at("2024-02-01 12:00"))
        assert labels(state)["3"] == "" and labels(state)["4"] == "Obra Nueva"
        # Also after a run that is worked out from the records.
        ingest_run(state, snapshot(spark, DAY_2), at("2024-02-01 15:00"))
        assert labels(state)["3"] == ""
    assert labels(one)["1"] == "+12.5%"
    empty = State(spark, str(tmp_path / "empty"))
    import_master(empty, master(spark, ["Avanz_01-01-2024"], []))
    ingest_run(empty, snapshot(spark, DAY_2), at("2024-02-01 12:00"))
    assert set(labels(empty).values()) == {"Obra Nueva"}


def test_projects_leave_the_deny_list_by_bare_key_or_pair(spark, tmp_path):
    state = State(spark, str(tmp_path))
    ingest_run(state, snapshot(spark, [(str(k), r, f"C{k % 2}", "S", "", "") for k, r in enumerate(["Sicilia", "Puglia", "Puglia", "Lazio"])]), at("2024-01-01 12:00"))
    deny_rows(state, state.entities().selectExpr("*", "work_id AS seq"), date(2024, 1, 1))
    assert state.entries().count() == 4
    assert undeny(state, spark.createDataFrame([(" C0 ",), ("C7",)], "project_key string")) == 2
    assert {r.project_key for r in state.entries().collect()} == {"C1"}
    none = spark.createDataFrame([], "project_key string")
    assert undeny(state, none, spark.createDataFrame([("C1", " PUGLIA"), ("C1", "Sicilia")], "project_key string, region string")) == 1
    assert [(r.project_key, r.region) for r in state.entries().collect()] == [("C1", "Lazio")]
    assert denylist.change_counts(state.entries(), state.entries()) == {"added": 0, "removed": 0}


def test_snapshots_of_known_days_are_left_alone(spark, tmp_path):
    state = State(spark, str(tmp_path))
    ingest_run(state, snapshot(spark, DAY_1), at("2024-01-01 12:00"))
    landed = {at("2024-01-01 18:00"): snapshot(spark, DAY_2), at("2024-02-01 12:00"): snapshot(spark, DAY_2), at("2023-12-01 12:00"): snapshot(spark, DAY_1[:2])}
    assert ingest_new_days(state, landed) == [at("2023-12-01 12:00"), at("2024-02-01 12:00")]
    assert state.runs().count() == 3 and ingest_new_days(state, landed) == [] and ingest_new_days(state, {}) == []
