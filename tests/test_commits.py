"""Reads as of a commit, and the changes between two."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from test_jobs import DAY_1, DAY_2, at, snapshot

from snaptrack.operators import reconcile as R
from snaptrack.operators.changes import apply_feed, change_feed
from snaptrack.plans.state import State, drop_expired_runs, drop_expired_versions, ingest_run, pin, save_tags, unpin


def shown(state):
    return tuple(sorted(map(str, df.collect())) for df in (state.labelled(), state.entries(), state.history()))


def test_every_commit_reads_as_it_was_and_feeds_lead_from_one_to_the_next(spark, tmp_path):
    state = State(spark, str(tmp_path))
    kind = "work_id string, seq int, new_tag string"
    jobs = [
        lambda: ingest_run(state, snapshot(spark, DAY_1), at("2024-01-01 12:00")),
        lambda: ingest_run(state, snapshot(spark, DAY_2), at("2024-02-01 12:00")),
        lambda: save_tags(state, spark.createDataFrame([("1", 1, "Non interessa")], kind), date(2024, 2, 2)),
        lambda: ingest_run(state, snapshot(spark, DAY_1[1:]), at("2024-01-15 12:00")),
    ]
    seen = []
    for job in jobs:
        job()
        seen.append(shown(state))
    assert [shown(state.at(n)) for n in range(1, 5)] == seen
    # Retention moves the horizon in a commit of its own; pinned commits stay whole.
    pin(state, 1)
    pin(state, 3)
    drop_expired_runs(state, keep=1)
    drop_expired_versions(state, keep=1)
    assert [shown(state.at(n)) for n in (1, 3)] == [seen[0], seen[2]] and shown(state) == seen[3]
    for gone in (2, 4, 99):
        with pytest.raises(LookupError):
            state.at(gone)
    one, two = (s.labelled() for s in (state.at(1), state))
    feed = change_feed(one, two, R.SIGNATURE)
    there = apply_feed(one, feed, R.SIGNATURE).select(*two.columns)
    assert sorted(map(str, there.collect())) == sorted(map(str, two.collect()))
    back = apply_feed(two, change_feed(two, one, R.SIGNATURE), R.SIGNATURE).select(*one.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, one.collect()))
    rows = {r.sig_id: (r.kind, set(r.columns)) for r in feed.collect()}
    assert rows["4"] == ("added", set()) and rows["1"][0] == "changed" and {"tag", "label", "region"} <= rows["1"][1]
    assert change_feed(two, two, R.SIGNATURE).count() == 0
    with pytest.raises(ValueError, match="past"):
        ingest_run(state.at(3), snapshot(spark, DAY_2), at("2024-05-01 12:00"))
    unpin(state, 1)
    drop_expired_versions(state, keep=1)
    with pytest.raises(LookupError):
        state.at(1)


def test_feed_of_nulls_and_extra_columns(spark):
    kind = "k string, v string, `a.b` int"
    old = spark.createDataFrame([("1", None, 1), ("2", "x", None), ("3", "y", 3)], kind)
    new = spark.createDataFrame([("1", None, 1), ("2", None, None), ("4", "z", 4)], kind).withColumn("more", F.lit(1))
    feed = {r.k: (r.kind, r.columns) for r in change_feed(old, new, ["k"]).collect()}
    assert feed == {"2": ("changed", ["v"]), "3": ("gone", []), "4": ("added", [])}
    assert change_feed(old.limit(0), new.limit(0), ["k"]).collect() == []
    folded = apply_feed(old, change_feed(old, new, ["k"]), ["k"])
    assert sorted(map(tuple, folded.collect()), key=str) == sorted(map(tuple, new.drop("more").collect()), key=str)
