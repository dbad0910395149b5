"""Presence bitmaps against sets."""

import random
from datetime import datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from test_plans import plan_of

from snaptrack.operators import presence as P

KEYS = ("project", "work")
KIND = "project string, work string, run_ts timestamp"


def random_runs(seed, runs=20, entities=60):
    rng = random.Random(seed)
    known = [(rng.choice(["C1", "C2", None, ""]), rng.choice([None, str(k)])) for k in range(entities)]
    days = [datetime(2024, 1, 1) + timedelta(days=k) for k in range(runs - 1)] + [None]
    return {day: {e for e in known if rng.random() < rng.choice([0.1, 0.5, 0.9])} for day in days}


def history_of(spark, seen):
    return spark.createDataFrame([(*e, day) for day, es in seen.items() for e in es for _ in range(2)], KIND)


def in_time(day):
    return day or datetime(1, 1, 1)


@pytest.mark.parametrize("cells", [1, 7])
def test_all_pairs_of_runs_are_set_operations(spark, cells):
    seen = random_runs(cells)
    table = P.bitmaps(P.numbered(history_of(spark, seen), KEYS, cells))
    absent = datetime(2030, 1, 1)
    pairs = [*combinations(seen, 2), (absent, None), *[(d, d) for d in list(seen)[:1]]]
    got = {(r.older_run, r.newer_run): (r.in_both, r.only_newer, r.only_older) for r in P.between(table, pairs).collect()}
    sets = {**seen, absent: set()}
    assert got == {(a, b): (len(sets[a] & sets[b]), len(sets[b] - sets[a]), len(sets[a] - sets[b])) for a, b in pairs}
    assert {r.run_ts: r.entities for r in P.sizes(table).collect()} == {d: len(es) for d, es in seen.items() if es}


def test_first_seen(spark):
    seen = random_runs(3)
    table = P.bitmaps(P.numbered(history_of(spark, seen), KEYS, 3))
    so_far, want = set(), {}
    for day in sorted(seen, key=in_time):
        if seen[day]:
            want[day] = (len(seen[day]), len(seen[day] - so_far), len(so_far | seen[day]))
        so_far |= seen[day]
    assert {r.run_ts: (r.entities, r.first_seen, r.known) for r in P.first_seen(table).collect()} == want


def test_members_of_any_runs(spark):
    seen = random_runs(5)
    rows = P.numbered(history_of(spark, seen), KEYS, 4)
    known, table = P.register(rows, KEYS), P.bitmaps(rows)
    days = list(seen)
    for present, absent in ((days[:1], []), (days[1:3], days[4:6]), ([None], days[:3]), (days[:2], days[:1]), ([datetime(2030, 1, 1)], [])):
        want = set.intersection(*[seen.get(d, set()) for d in present]) - set().union(*[seen[d] for d in absent])
        got = [(r.project, r.work) for r in P.members(known, table, present, absent).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    with pytest.raises(ValueError):
        P.members(known, table, [])


def test_runs_added_one_by_one_late_and_again(spark):
    seen = random_runs(8, runs=6)
    days = list(seen)
    rows = P.numbered(history_of(spark, {d: seen[d] for d in days[:2]}), KEYS, 3)
    known, table = P.register(rows, KEYS), P.bitmaps(rows)
    places = {(r.project, r.work): (r.cell, r.part, r.bit) for r in known.collect()}
    again = {**seen, days[0]: set(list(seen[days[0]])[1:]) | {("C9", "new")}}
    for day in (days[4], days[2], days[5], days[3], days[0]):
        kind = "project string, work string, cell long, part long, bit long"
        run = P.number_run(known, history_of(spark, {day: again[day]}), KEYS, 3)
        table = spark.createDataFrame(P.with_run(table, run).collect(), table.schema)
        grown = known.unionByName(P.register(run, KEYS)).distinct()
        known = spark.createDataFrame([tuple(r) for r in grown.select(*KEYS, *P.PLACE, "bit").collect()], kind)
    now = {(r.project, r.work): (r.cell, r.part, r.bit) for r in known.collect()}
    assert len(set(now.values())) == len(now) == known.count()
    assert {e: now[e] for e in places} == places
    for day in days:
        got = {(r.project, r.work) for r in P.members(known, table, [day]).collect()}
        assert got == again[day]


def test_a_cell_may_have_many_parts(spark):
    history = spark.range(70_000).select(
        F.lit("C").alias("project"), F.col("id").cast("string").alias("work"),
        F.when(F.col("id") % 2 == 0, F.lit(datetime(2024, 1, 1))).otherwise(F.lit(datetime(2024, 1, 2))).alias("run_ts"))
    rows = P.numbered(history.unionByName(history.limit(5).withColumn("run_ts", F.lit(datetime(2024, 1, 2)))), KEYS, 1)
    known, table = P.register(rows, KEYS), P.bitmaps(rows)
    assert {r.part for r in table.collect()} == {1, 2, 3}
    one = P.between(table, [(datetime(2024, 1, 1), datetime(2024, 1, 2))]).first()
    assert one.in_both + one.only_newer == 35_000 + one.in_both and one.in_both + one.only_older == 35_000
    assert P.members(known, table, [datetime(2024, 1, 1)], [datetime(2024, 1, 2)]).count() == one.only_older


def test_no_history(spark):
    none = spark.createDataFrame([], KIND)
    rows = P.numbered(none, KEYS, P.cells_for(none, KEYS))
    table = P.bitmaps(rows)
    assert P.first_seen(table).count() == 0 and P.members(P.register(rows, KEYS), table, [None]).count() == 0
    same = P.with_run(table, P.number_run(P.register(rows, KEYS), none, KEYS, 1))
    assert same.count() == 0


def test_the_history_is_scanned_once(spark, tmp_path):
    history_of(spark, random_runs(1)).write.parquet(str(tmp_path / "h"))
    table = P.bitmaps(P.numbered(spark.read.parquet(str(tmp_path / "h")), KEYS, 2))
    plan = plan_of(P.between(table, [(datetime(2024, 1, 1), datetime(2024, 1, 2))]))
    assert plan.count("FileScan") == 1
    # Dealt to cells once; bitmaps, pairs and their parts need no shuffle of rows after that.
    assert plan_of(table).count("Exchange hashpartitioning(cell") == 1 and plan_of(table).count("Exchange") == 2
