"""Operators on small tables, one trap at a time."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from snaptrack.operators import denylist, enrich, history, lifecycle, reconcile, shape, views
from snaptrack.operators.dedupe import keep_first, keep_last

WORK = "work_id string, region string, project_key string, road_code string, contractor string, progress string"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_keep_first_ignores_input_order_and_partitioning(spark):
    data = [(k, rng, f"v{rng}") for k in ("a", "b") for rng in range(20)]
    want = {("a", 0, "v0"), ("b", 0, "v0")}
    for seed, parts in ((1, 1), (2, 7)):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, n int, v string").repartition(parts)
        assert set(map(tuple, keep_first(df, ["k"], ["n"]).collect())) == want
        assert rows(keep_last(df, ["k"], ["n"]), "k", "n") == [("a", 19), ("b", 19)]


def test_match_uses_project_region_and_id(spark):
    old = spark.createDataFrame(
        [("1", "Sicilia", " C1", "", "", ""), ("2", "Puglia", "C2", "", "", ""), ("3", "x", "C3", "", "", "")], WORK
    )
    new = spark.createDataFrame(
        [("1 ", " SICILIA ", "C1", "", "", ""), ("2", "Puglia", "CHANGED", "", "", ""), ("4", "x", "C4", "", "", "")],
        WORK,
    )
    matched = reconcile.match(reconcile.one_row_per_work(old), reconcile.one_row_per_work(new))
    # An id whose project changed is a vanished work and a new one.
    assert rows(matched, "sig_id", "sig_project", "status") == [
        ("1", "C1", "both"), ("2", "C2", "gone"), ("2", "CHANGED", "new"), ("3", "C3", "gone"), ("4", "C4", "new"),
    ]


def test_merge_never_replaces_a_value_by_a_blank(spark):
    blanks = ["", " ", "None", "nan", "0.000000, 0.000000", None]
    old = spark.createDataFrame([(str(i), "R", "C", "", "kept", "") for i in range(len(blanks) + 1)], WORK)
    new = spark.createDataFrame(
        [(str(i), "r", "C", "", v, "") for i, v in enumerate([*blanks, "better"])], WORK
    )
    matched = reconcile.match(old, new)
    merged = reconcile.merge_nonblank(matched, ["contractor", "region"], owned=("work_id",))
    want = [(str(i), "kept", "r") for i in range(len(blanks))] + [(str(len(blanks)), "better", "r")]
    assert rows(merged, "work_id", "contractor", "region") == want
    counters = reconcile.merge_counters(matched, ["contractor", "region"]).first()
    assert (counters.cells_updated, counters.cells_preserved) == (8, 6)


def _history(spark, observed):
    return spark.createDataFrame(
        [(k, datetime.fromisoformat(t), p) for k, t, p in observed], "k string, run_ts timestamp, pct_text string"
    ).withColumn("pct", F.expr("try_cast(replace(pct_text, ',', '.') as double)"))


def test_delta_compares_the_two_latest_runs_of_the_table(spark):
    h = _history(spark, [("a", "2024-01-01", "1"), ("a", "2024-01-02", "5"), ("a", "2024-01-03", "7,5"),
                         ("b", "2024-01-01", "1"), ("b", "2024-01-03", "9"), ("c", "2024-01-02", "3")])
    assert rows(history.run_delta(h, ["k"]), "k", "delta_label") == [("a", "+2.5%"), ("b", ""), ("c", "")]


def test_same_day_rerun_removes_the_earlier_run_for_everyone(spark):
    h = _history(spark, [("a", "2024-01-01 08:00", "1"), ("b", "2024-01-01 08:00", "2"), ("a", "2024-01-01 09:00", "3")])
    assert rows(history.same_day_replace(h), "k", "pct_text") == [("a", "3")]


def _labels(spark, observed):
    return dict(rows(lifecycle.label_history(_history(spark, observed), ["k"]), "k", "label"))


def test_first_run_is_all_new(spark):
    assert _labels(spark, [("a", "2024-01-01", "1"), ("b", "2024-01-01", "")]) == {"a": "Obra Nueva", "b": "Obra Nueva"}


def test_gone_by_last_known_progress(spark):
    last = {"a": "100", "b": "99,99", "c": "80", "d": "79,99", "e": "", "f": "abc"}
    observed = [(k, "2024-01-01", p) for k, p in last.items()]
    observed += [("c", "2024-01-02", "nan"), ("x", "2024-01-03", "1")]
    assert _labels(spark, observed) == {
        "a": "Obra Conclusa", "b": "Obra Conclusa (probable)", "c": "Obra Conclusa (probable)",
        "d": "Obra Desaparecida", "e": "Obra Desaparecida", "f": "Obra Desaparecida", "x": "Obra Nueva",
    }


def test_rerun_on_the_first_day_blanks_new_and_drops_unseen(spark):
    observed = [("a", "2024-01-01 08:00", "1"), ("b", "2024-01-01 08:00", "95"),
                ("a", "2024-01-01 09:00", "2"), ("c", "2024-01-01 09:00", "3")]
    # "b" was only in the replaced run, so nothing is known about it.
    assert _labels(spark, observed) == {"a": "", "b": "Obra Desaparecida", "c": "Obra Nueva"}


def test_a_key_that_returns_gets_a_delta_again(spark):
    observed = [("a", "2024-01-01", "5"), ("z", "2024-01-02", "1"), ("a", "2024-01-03", "6"), ("z", "2024-01-03", "1")]
    assert _labels(spark, observed) == {"a": "", "z": "0%"}


def test_calendar_positions(spark):
    days = ["2023-12-31 23:00", "2024-01-01 00:00", "2024-01-01 10:00", "2024-03-05 00:00"]
    h = _history(spark, [("a", d, "1") for d in days] * 2)
    calendar = history.run_calendar(h).orderBy("position").collect()
    assert [r.position for r in calendar] == [1, 2, 3, 4]
    assert [f"{r.run_ts:%Y-%m-%d %H:%M}" for r in calendar] == days


def test_wide_and_long_are_inverse(spark):
    observed = [("a", "2024-01-01", "1"), ("a", "2024-01-02", "2"), ("b", "2024-01-02", "3")]
    h = _history(spark, observed)
    runs = history.newest_run_list(history.distinct_runs(h), 5)
    wide = history.to_wide(h, ["k"], runs)
    assert wide.columns == ["k", "Avanz_01-01-2024_0000", "Avanz_02-01-2024_0000"]
    long = history.to_long(wide, ["k"]).where(F.col("pct_text").isNotNull())
    assert rows(long, "k", "pct_text", "run_date") == [
        ("a", "1", date(2024, 1, 1)), ("a", "2", date(2024, 1, 2)), ("b", "3", date(2024, 1, 2))
    ]
    with pytest.raises(ValueError):
        history.to_wide(h, ["k"], [runs[0], runs[0]])


DENY = "project_key string, region string, contractor string, description string, added_on string, seq int"


def deny(spark, *pairs):
    return spark.createDataFrame([(p, r, "", "", "", i) for i, (p, r) in enumerate(pairs)], DENY)


@pytest.mark.parametrize(
    "row, entry, hit",
    [(("C1", "Sicilia"), ("C1", "sicilia"), True), (("C1", "Sicilia"), ("C1", ""), True),
     (("C1", ""), ("C1", "Sicilia"), True), (("C1", "Puglia"), ("C1", "Sicilia"), False),
     (("", "Sicilia"), ("", "Sicilia"), False), (("c1", "Sicilia"), ("C1", "Sicilia"), False),
     ((" C1 ", None), ("C1 ", "Sicilia"), True)],
)
def test_deny_match(spark, row, entry, hit):
    r = spark.createDataFrame([row], "project_key string, region string")
    assert denylist.with_denied(r, deny(spark, entry)).first().denied is hit


def test_deny_match_equals_brute_force(spark):
    rng = random.Random(3)

    def some():
        # One project holds a third of everything.
        return ("HOT" if rng.random() < 0.34 else f"C{rng.randrange(20)}", rng.choice(["", "A", "b", "B ", "c"]))

    entries, works = [some() for _ in range(25)], [some() for _ in range(400)]
    df = spark.createDataFrame([(i, *w) for i, w in enumerate(works)], "i int, project_key string, region string")
    got = dict(rows(denylist.with_denied(df, deny(spark, *entries)), "i", "denied"))

    def denied(p, r):
        r = r.strip().lower()
        return any(p == e and (not s.strip() or not r or s.strip().lower() == r) for e, s in entries)

    assert got == {i: denied(*w) for i, w in enumerate(works)}


def test_denied_rows_keep_a_tag_the_user_set(spark):
    r = spark.createDataFrame([("1", "C1", "", ""), ("2", "C1", "", "In VTiger")], "work_id string, project_key string, region string, tag string")
    e = deny(spark, ("C1", ""))
    assert rows(denylist.tag_denied(r, e), "work_id", "tag") == [("1", "Non interessa"), ("2", "In VTiger")]
    forced = denylist.tag_denied(r, e, only_blank=False)
    assert rows(forced, "work_id", "tag") == [("1", "Non interessa"), ("2", "Non interessa")]


def test_deny_list_add_remove_compact(spark):
    current = deny(spark, ("C1", "Sicilia"))
    more = deny(spark, ("C1", " SICILIA"), ("C2", "x"), ("C2", "X "), ("None", ""), (" ", ""))
    listed = denylist.add(current, more, date(2024, 7, 1))
    assert rows(listed, "project_key", "region", "added") == [("C1", "Sicilia", False), ("C2", "x", True)]
    three = deny(spark, ("C1", "A"), ("C1", "B"), ("C2", "A"), ("C3", "A"))
    left = denylist.remove(three, deny(spark, ("C1", "")), deny(spark, ("C2", "a"), ("C3", "other")))
    assert rows(left, "project_key", "region") == [("C3", "A")]
    long = current.withColumn("description", F.repeat(F.lit("x"), F.lit(200)))
    stored = denylist.compact(long, date(2024, 7, 1)).first()
    assert len(stored.description) == 140 and stored.added_on == "2024-07-01"


def test_edits_last_one_wins_and_reach_every_row_of_the_id(spark):
    r = spark.createDataFrame([("1", ""), ("1", "In VTiger"), ("2", "")], "work_id string, tag string")
    edits = spark.createDataFrame([("1", 1, "Da caricare"), ("1", 2, "")], "work_id string, seq int, new_tag string")
    assert rows(denylist.apply_edits(r, edits), "work_id", "tag") == [("1", ""), ("1", ""), ("2", "")]


def test_untagging_takes_the_entry_off_the_list(spark):
    edited = spark.createDataFrame(
        [("C1", "Sicilia", "", "", 1, ""), ("C2", "Puglia", "", "", 2, "Non interessa")],
        "project_key string, region string, contractor string, description string, seq int, new_tag string",
    )
    listed = denylist.sync_with_edits(deny(spark, ("C1", "sicilia")), edited, date(2024, 7, 1))
    assert rows(listed, "project_key", "region") == [("C2", "Puglia")]


ENTITY = "work_id string, project_key string, region string, official_name string, province string, municipalities string, coordinate string"


def test_safe_write_fills_only_what_is_needed(spark):
    e = spark.createDataFrame(
        [("1", "C1", "", "", "old", "", ""), ("2", "C1", "", "named", "old", "", ""), ("3", "C9", "", "", "", "", "")], ENTITY
    )
    cache = spark.createDataFrame([("C1", "Name", "nan", "M")], "project_key string, official_name string, province string, municipalities string")
    fields = ("official_name", "province", "municipalities")
    written = enrich.safe_write(enrich.worklist(e), cache, fields)
    assert rows(written, "work_id", *fields, "fields_written") == [
        ("1", "Name", "old", "M", 2), ("2", "named", "old", "", 0), ("3", "", "", "", 0)
    ]
    forced = enrich.safe_write(enrich.worklist(e, force=True), cache, fields)
    assert rows(forced, "work_id", "official_name")[1] == ("2", "Name")


def test_gazetteer_falls_back_level_by_level(spark):
    gazetteer = spark.createDataFrame(
        [("Catania", "CT", "Sicilia", 2, 37.5, 15.0), ("Catania", "CT", "Sicilia", 1, 1.0, 1.0),
         ("Bari", "BA", "Puglia", 1, 0.0, 0.0), ("Bari", "XX", "Puglia", 2, 41.0, 16.0),
         ("Other", "TA", "Puglia", 1, 40.0, 17.0)],
        "municipality string, province string, region string, rank int, lat double, lng double",
    )
    places = [("a", "Catania, x", "CT", "Sicilia"), ("b", "CATANIA", "none", "Sicilia"), ("c", "Catania", "", ""),
              ("d", "Bari", "BA", "Puglia"), ("e", "", "TA", ""), ("f", "Nowhere", "TA", ""), ("g", "", "", "Puglia"),
              ("h", "Bari", "XX", "")]
    e = spark.createDataFrame([(k, k, r, "n", p, m, "") for k, m, p, r in places], ENTITY)
    filled = dict(rows(enrich.fill_coordinates(enrich.worklist(e), gazetteer), "work_id", "coordinate"))
    first = "1.000000, 1.000000"
    # "d": every first hit for Bari is the placeless one, at each level.
    assert filled == {"a": first, "b": first, "c": first, "d": "", "e": "40.000000, 17.000000", "f": "", "g": "",
                      "h": "41.000000, 16.000000"}


def test_cache_upsert_keeps_the_old_record_when_the_new_one_is_empty(spark):
    kind = "project_key string, official_name string"
    cache = spark.createDataFrame([("C1", "a"), ("C2", "b")], kind)
    fetched = spark.createDataFrame([("C1", "A"), ("C2", None), ("C3", "c")], kind)
    merged = enrich.upsert_cache(cache, fetched, F.col("official_name").isNull())
    assert rows(merged, "project_key", "official_name") == [("C1", "A"), ("C2", "b"), ("C3", "c")]


def test_view_filters(spark):
    v = spark.createDataFrame(
        [("1", "A", "t", 50.0, "+1.0%", "Bridge (new)"), ("2", "B", "t", None, "Obra Nueva", None), ("3", "A", "u", 99.0, "", "road")],
        "work_id string, region string, work_type string, pct_now double, label string, description string",
    )
    assert rows(views.view(v), "work_id") == [("1",), ("2",), ("3",)]
    assert rows(views.view(v, progress=(60, 100)), "work_id") == [("2",), ("3",)]
    assert rows(views.view(v, labels=["Obra Nueva"]), "work_id") == [("1",), ("2",)]
    assert rows(views.view(v, query="BRIDGE|ROAD", regions=["A"]), "work_id") == [("1",), ("3",)]
    assert rows(views.search(v, "(new)", ["description"], regex=False), "work_id") == [("1",)]
    assert views.column_plan(v.withColumn("_x", F.lit(1)), ["region", "_x", "none"]) == ["region", "label"]


def test_kpis_without_amounts(spark):
    v = spark.createDataFrame([("Obra Nueva", ""), ("0%", "x")], "label string, amount_total string")
    got = views.kpis(v).first()
    assert (got.works, got.new, got.amount, got.amount_millions) == (2, 1, 0.0, "N/D")


def test_migrate_flag_keeps_an_existing_tag(spark):
    both = spark.createDataFrame([("si", "Da caricare"), ("si", None)], "VTiger string, tag string")
    assert rows(shape.migrate_flag(both), "tag") == [("",), ("Da caricare",)]
    assert shape.migrate_flag(both).columns == ["tag"]
