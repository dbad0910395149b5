"""Interval-encoded history, and labels that retention does not change."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_jobs import DAY_1, DAY_2, at, labels, snapshot

from snaptrack.operators import intervals, lifecycle
from snaptrack.operators import reconcile as R
from snaptrack.operators.lifecycle import label_history
from snaptrack.plans.state import State, drop_expired_runs, drop_expired_versions, ingest_run

KEYS = ["k"]
SCHEMA = "k string, run_ts timestamp, pct_text string, pct double"


def _history(seed, runs=12, entities=9):
    """Few values, so that stretches form; entities come and go; some days have two runs."""
    rng = random.Random(seed)
    times = [datetime(2024, 1, 1, 8) + timedelta(hours=17 * r) for r in range(runs)]
    rows = []
    for e in range(entities):
        for t in times:
            if rng.random() < 0.8:
                v = rng.choice([None, "", "5", "90"])
                rows.append((f"e{e}", t, v, float(v) if v else None))
    return times, rows


def _plain(rows, times):
    """Stretches in plain loops."""
    found, place = [], {t: i for i, t in enumerate(sorted(times))}
    for k, own in itertools.groupby(sorted(rows, key=lambda r: (r[0], r[1])), key=lambda r: r[0]):
        last = None
        for _, t, text, pct in own:
            if last and last[1:3] == [text, pct] and place[last[4]] + 1 == place[t]:
                last[4] = t
            else:
                last = [k, text, pct, t, t]
                found.append(last)
    return sorted(map(str, found))


def _shown(df):
    return sorted(str(list(r)) for r in df.select("k", "pct_text", "pct", "valid_from", "valid_to").collect())


@pytest.mark.parametrize("seed", range(2))
def test_stretches_and_back(spark, seed):
    times, rows = _history(seed)
    history = spark.createDataFrame(rows, SCHEMA)
    runs = history.select("run_ts").distinct()
    stretches = intervals.encode(history, KEYS).cache()
    assert _shown(stretches) == _plain(rows, times)
    back = intervals.decode(stretches, runs).select(*history.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, history.collect()))
    for t in times[::5]:
        own = intervals.as_of(stretches, t).select(*history.columns)
        assert sorted(map(str, own.collect())) == sorted(map(str, history.where(F.col("run_ts") == F.lit(t)).collect()))


def test_a_late_or_repeated_run_splits_stretches(spark):
    times, rows = _history(7)
    whole = spark.createDataFrame(rows, SCHEMA)
    for k in (0, 5, len(times) - 1):
        late = F.col("run_ts") == F.lit(times[k])
        before = whole.where(~late)
        again = intervals.with_run(intervals.encode(before, KEYS), whole.where(late), times[k], KEYS, whole)
        assert _shown(again) == _plain(rows, times)
        # The same run once more, with other rows.
        other = [("new", times[k], "7", 7.0), ("e1", times[k], "5", 5.0)]
        replaced = intervals.with_run(again, spark.createDataFrame(other, SCHEMA), times[k], KEYS, whole)
        assert _shown(replaced) == _plain([r for r in rows if r[1] != times[k]] + other, times)


def test_unchanged_entities_cost_nothing_and_one_shuffle_does(spark):
    times = [datetime(2024, 1, 1) + timedelta(days=d) for d in range(40)]
    history = spark.createDataFrame([(f"e{e}", t, "5", 5.0) for e in range(3) for t in times], SCHEMA)
    stretches = intervals.encode(history, KEYS)
    assert stretches.count() == 3
    plan = stretches._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(k#") == 1


def test_runs_of_no_time_come_first(spark):
    rows = [("a", None, "5", 5.0), ("a", at("2024-01-01"), "5", 5.0), ("b", at("2024-01-01"), "6", 6.0), ("a", at("2024-01-02"), None, None)]
    history = spark.createDataFrame(rows, SCHEMA)
    assert intervals.encode(history, KEYS).count() == 3
    assert intervals.encode(history.limit(0), KEYS).collect() == []


@pytest.mark.parametrize("seed", range(2))
def test_records_of_any_blocks_merge_to_the_facts_of_all(spark, seed):
    """Blocks of runs in any grouping, some of them as stretches, whatever their order."""
    times, rows = _history(seed + 20)
    whole = spark.createDataFrame(rows, SCHEMA)
    runs = whole.select("run_ts").distinct()
    newest = max(times)
    before = max(t for t in times if t.date() < newest.date())
    is_newest = F.col("run_ts") == F.lit(newest)
    want = sorted(map(str, lifecycle.history_facts(whole, KEYS).collect()))
    rng = random.Random(seed)
    for parts in (1, 3):
        of = {t: rng.randrange(parts) for t in times}
        blocks = [whole.where(~is_newest & F.col("run_ts").isin([t for t in times if of[t] == p])) for p in range(parts)]
        records = [lifecycle.fact_records(b, runs, KEYS) for b in blocks]
        old = whole.where(F.col("run_ts").isin(times[:4]))
        records[0] = records[0].unionByName(lifecycle.stretch_records(intervals.encode(old, KEYS), runs, KEYS))
        merged = lifecycle.merge_records(records[0], KEYS)
        for r in records[1:]:
            merged = lifecycle.merge_records(merged.unionByName(r), KEYS)
        facts = lifecycle.facts_of(merged, whole.where(is_newest), F.lit(before), KEYS)
        assert sorted(map(str, facts.collect())) == want


def _runs(seed):
    """Six runs on four days, two days with two runs each."""
    rng = random.Random(seed)
    times = ["2024-01-01 08:00", "2024-01-01 20:00", "2024-02-01 08:00", "2024-03-01 08:00", "2024-03-01 09:00", "2024-04-01 08:00"]
    for t in times:
        works = [(str(i), "Sicilia", f"C{i}", "S", rng.choice(["", "x"]), rng.choice(["", "5", "85", "100"]))
                 for i in range(10) if rng.random() < 0.6]
        yield at(t), works or [("0", "Sicilia", "C0", "S", "", "1")]


@pytest.mark.parametrize("keep", [1, 2, 4])
def test_labels_are_those_of_a_full_replay_for_any_order_and_retention(spark, tmp_path, keep):
    runs = list(_runs(keep))
    order = random.Random(keep * 7).sample(range(6), 6)
    state = State(spark, str(tmp_path))
    for n, k in enumerate(order):
        ingest_run(state, snapshot(spark, runs[k][1]), runs[k][0])
        drop_expired_runs(state, keep)
        if n not in (2, 5):
            continue
        seen = None
        for j in order[: n + 1]:
            rows = R.observations(R.one_row_per_work(snapshot(spark, runs[j][1])), F.lit(runs[j][0]))
            seen = rows if seen is None else seen.unionByName(rows)
        whole = label_history(seen, R.SIGNATURE)
        own = state.labelled().select(whole.columns)
        assert sorted(map(str, own.collect())) == sorted(map(str, whole.collect())), (order, n)
    drop_expired_versions(state, 1)
    shown = [*R.SIGNATURE, "run_ts", "pct_text"]
    own = state.observations().select(*shown)
    assert sorted(map(str, own.collect())) == sorted(map(str, seen.select(*shown).collect()))


def test_a_same_day_run_after_retention_loses_no_label(spark, tmp_path):
    state = State(spark, str(tmp_path))
    works = {k: (str(k), "Sicilia", f"C{k}", "S", "", p) for k, p in ((1, "90"), (2, "10"), (3, "20"))}
    ingest_run(state, snapshot(spark, list(works.values())), at("2024-01-01 12:00"))
    ingest_run(state, snapshot(spark, [works[2]]), at("2024-02-01 12:00"))
    ingest_run(state, snapshot(spark, [works[2]]), at("2024-03-01 12:00"))
    assert drop_expired_runs(state, keep=1) == 2
    gone = {"1": "Obra Conclusa (probable)", "2": "0%", "3": "Obra Desaparecida"}
    assert labels(state) == gone
    ingest_run(state, snapshot(spark, [works[2], works[3]]), at("2024-03-01 15:00"))
    assert labels(state) == {**gone, "3": ""}
    # A late run, and an old one again, behind the horizon.
    ingest_run(state, snapshot(spark, [(*works[2][:5], "4"), works[3]]), at("2024-02-15 12:00"))
    assert labels(state) == {**gone, "2": "+6.0%", "3": "0%"}
    ingest_run(state, snapshot(spark, [(*works[1][:5], "100"), works[2]]), at("2024-01-01 12:00"))
    assert labels(state)["1"] == "Obra Conclusa"
    assert state.snapshot_of(at("2024-02-01 12:00")).select("work_id", "progress").collect() == [("2", "10")]
    assert {r.work_id for r in state.snapshot_of(at("2024-03-01 15:00")).collect()} == {"2", "3"}
    wide = {r.work_id: list(r)[-4:] for r in state.wide(5).collect()}
    assert wide == {"1": ["100", None, None, None], "2": ["10", "10", "4", "10"], "3": [None, None, "20", "20"]}


def test_no_job_reads_snapshots_behind_the_horizon(spark, tmp_path):
    state = State(spark, str(tmp_path))
    for run, works in (("2024-01-01 12:00", DAY_1), ("2024-02-01 12:00", DAY_2), ("2024-03-01 12:00", DAY_1)):
        ingest_run(state, snapshot(spark, works), at(run))
    before = labels(state)
    drop_expired_runs(state, keep=1)
    assert labels(state) == before and sorted(p.name for p in (tmp_path / "snapshots").iterdir()) == ["sequence=3"]
    assert state.head().horizon_ts == at("2024-02-01 12:00")
    # Unchanged works of the next folds add no rows to those that ended.
    for day in range(2, 6):
        ingest_run(state, snapshot(spark, DAY_1), at(f"2024-03-0{day} 12:00"))
        drop_expired_runs(state, keep=1)
    ended = state.stretches().where(F.col("valid_to") < F.lit(state.head().horizon_ts))
    assert ended.count() == 6  # three works of January that change or go, three of February
    assert drop_expired_versions(state, keep=1) > 0
    assert state.history().select("run_ts").distinct().count() == 7


def test_a_fold_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    state = State(spark, str(tmp_path))
    ingest_run(state, snapshot(spark, DAY_1), at("2024-01-01 12:00"))
    ingest_run(state, snapshot(spark, DAY_2), at("2024-02-01 12:00"))
    seen = lambda: (labels(state), sorted(map(str, state.history().collect())))
    before, real = seen(), State.folder
    for dies_at in ("stretches", "horizon", "commits"):
        def dying(self, table, sequence, dies_at=dies_at):
            if table == dies_at:
                raise RuntimeError("lost")
            return real(self, table, sequence)

        monkeypatch.setattr(State, "folder", dying)
        with pytest.raises(RuntimeError):
            drop_expired_runs(state, keep=1)
        monkeypatch.setattr(State, "folder", real)
        assert seen() == before
    # The next job takes the same number and does not see what the dead one wrote.
    ingest_run(state, snapshot(spark, DAY_2), at("2024-03-01 12:00"))
    assert state.stretches().count() == 0
    drop_expired_runs(state, keep=1)
    assert state.history().select("run_ts").distinct().count() == 3
