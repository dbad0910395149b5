"""State on disk, and the jobs that change it.

    <root>/snapshots/sequence=<n>/  one row per work of a run, with its signature and progress
    <root>/entities/sequence=<n>/   entities after a job
    <root>/facts/sequence=<n>/      per entity what its label needs, as of the newest run
    <root>/entries/sequence=<n>/    the deny-list
    <root>/cache/sequence=<n>/      cached registry records
    <root>/horizon/sequence=<n>/    per entity what its label needs of the runs behind the horizon
    <root>/stretches/sequence=<n>/  the rows of those runs, by stretches in which nothing changed
    <root>/intake/sequence=<n>/     rows of a checked run, kept=true until they are in the state, kept=false set aside
    <root>/unknown/sequence=<n>/    fields of a run's works that no column takes
    <root>/search/sequence=<n>/     trigram index of the labelled entities as of commit n, where one was asked for
    <root>/commits/sequence=<n>/    one row per job: what it was and which folders count from now on
    <root>/landed/sequence=<n>/     rows of batch n of the stream, by run; <root>/folded the batches done

Every job writes folders of its own number and, last, its commit row; readers go by the newest
commit. A job that dies half way, also one that repeats a visible run, leaves all that readers
see as it was and can simply be run again. One job writes at a time.

Labels come from the facts, which a newer run updates from its own rows and the facts before. A run
that arrives late, again or on a day that has one merges its own record with those of the stored
snapshots and of the horizon.

The horizon is the newest run whose snapshot is gone. `drop_expired_runs` moves it: it folds the
expired snapshots into the stretches and their records into the horizon's before it deletes them, so
no run is ever lost. Stretches that have ended are written once and stay; only those that reach the
horizon are written again. A run that belongs behind the horizon is put into the stretches, and the
horizon's records are then taken from these. No job reads a snapshot behind the horizon.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptrack import constants as K
from snaptrack.functions import html
from snaptrack.functions.numbers import parse_amount, parse_pct
from snaptrack.functions.text import is_blank, or_empty, strip
from snaptrack.operators import denylist, history, intervals, lifecycle, quarantine, views
from snaptrack.operators import enrich as E
from snaptrack.operators import reconcile as R
from snaptrack.operators.joins import lookup_join
from snaptrack.operators.shape import align_schema, as_text, project_snapshot
from snaptrack.operators.trigrams import TrigramIndex
from snaptrack.schemas import (
    CACHE, COMMITS, CORRUPT, DENY_ENTRIES, ENTITIES, ENTITY_COLUMNS, FACTS, MERGE_COLUMNS, PROGRESS,
    RECORD_COLUMNS, RECORDS, SNAPSHOT_ROWS, STRETCHES, UNKNOWN, UNKNOWN_ROWS, with_sequence,
)
from snaptrack.session import job_settings
from snaptrack.sources.landing import unknown_fields
from snaptrack.sources.runs import run_counts
from snaptrack.sources.snapshots import require_key

TABLES = ("snapshots", "entities", "facts", "entries", "cache", "horizon", "stretches")
SCHEMAS = {
    "snapshots": SNAPSHOT_ROWS, "entities": ENTITIES, "facts": FACTS, "entries": DENY_ENTRIES, "cache": CACHE,
    "horizon": RECORDS, "stretches": STRETCHES,
}
#: Written in one folder for each value of a column.
PARTS = {"stretches": ("open",)}


@dataclass(frozen=True)
class State:
    """The state of the newest commit, or of commit `until`, which can be read but not changed."""

    spark: SparkSession
    root: str
    until: int | None = None

    def folder(self, table: str, sequence: int) -> str:
        return f"{self.root}/{table}/sequence={sequence}"

    def commits(self) -> DataFrame:
        """One row per job done; an empty table before the first."""
        try:
            done = self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")
            return done if self.until is None else done.where(F.col("sequence") <= self.until)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMITS)

    def head(self) -> Row:
        """The newest commit; all zero before the first."""
        newest = self.commits().orderBy(F.desc("sequence")).limit(1).collect()
        return newest[0] if newest else Row(**{**dict.fromkeys(COMMITS.names), "sequence": 0, **dict.fromkeys(TABLES, 0)})

    def at(self, sequence: int) -> State:
        """The state as commit `sequence` left it; an error if retention has taken what it needs.
        Pinned commits (`pin`) keep it."""
        past = State(self.spark, self.root, sequence)
        if past.head().sequence != sequence:
            raise LookupError(f"there is no commit {sequence}")
        gone = sorted(f for f in past.needs() if not _exists(self, f))
        if gone:
            raise LookupError(f"commit {sequence} needs folders that are gone: {gone}")
        return past

    def needs(self) -> set[str]:
        """The folders that hold this state: one of each table, of the stretches one for each time the
        horizon moved, of the snapshots one for each run since."""
        head = self.head()
        tables = [t for t in TABLES if t not in ("snapshots", "stretches") and head[t]]
        found = {self.folder(t, head[t]) for t in tables}
        found |= {self.folder("snapshots", r.snapshots) for r in self.stored_runs().select("snapshots").collect()}
        if head.stretches:
            found |= {self.folder("stretches", n) for n in self.stretch_numbers()} | {f"{self.folder('stretches', head.stretches)}/open=true"}
        return found

    def runs(self) -> DataFrame:
        """Visible runs: of commits for the same run the newest."""
        known = self.commits().where(F.col("run_ts").isNotNull())
        return known.groupBy("run_ts").agg(F.max_by(F.struct(*known.columns), "sequence").alias("c")).select("c.*")

    def newest_run(self) -> datetime | None:
        return self.commits().agg(F.max("run_ts")).first()[0]

    def _read(self, table: str) -> DataFrame:
        sequence = self.head()[table]
        if not sequence:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(self.folder(table, sequence))

    def entities(self) -> DataFrame:
        return self._read("entities")

    def facts(self) -> DataFrame:
        return self._read("facts")

    def entries(self) -> DataFrame:
        """The deny-list, with a `seq` in stored order."""
        return self._read("entries").withColumn("seq", F.lit(0))

    def cache(self) -> DataFrame:
        return self._read("cache")

    def log(self, runs: DataFrame | None = None) -> DataFrame:
        """Snapshot rows of visible runs, replaced same-day runs included.

        The run table has one small row per run and is read from its own files, so Spark knows
        its size, broadcasts it and reads only the folders it names.
        """
        runs = self.runs() if runs is None else runs
        stored = self.spark.read.schema(with_sequence(SNAPSHOT_ROWS)).parquet(f"{self.root}/snapshots")
        wanted = runs.select(F.col("snapshots").alias("sequence"))
        return stored.join(F.broadcast(wanted), "sequence", "left_semi").drop("sequence")

    def horizon(self) -> DataFrame:
        return self._read("horizon")

    def stretches(self) -> DataFrame:
        """The rows of all runs behind the horizon: those that have ended from every job that wrote
        some, those that reach the horizon from the newest."""
        head = self.head()
        if not head.stretches:
            return self.spark.createDataFrame([], STRETCHES).drop("open")
        stored = self.spark.read.schema(with_sequence(STRETCHES)).parquet(f"{self.root}/stretches")
        ended = ~F.col("open") & F.col("sequence").isin(self.stretch_numbers())
        return stored.where(ended | (F.col("open") & (F.col("sequence") == head.stretches))).drop("open", "sequence")

    def stretch_numbers(self) -> list[int]:
        """Numbers of the jobs that wrote stretches which still count: one for each time the horizon moved."""
        written = self.commits().where(F.col("stretches") >= self.head().stretches_since).select("stretches").distinct()
        return sorted(r.stretches for r in written.collect())

    def open_stretches(self) -> DataFrame:
        """The rows that reach the horizon."""
        return self._read("stretches").where("open").drop("open")

    def runs_behind(self) -> DataFrame:
        """The runs that the stretches hold."""
        return self.runs().where(F.col("run_ts") <= F.lit(self.head().horizon_ts))

    def stored_runs(self) -> DataFrame:
        """The runs whose snapshots count: all that are newer than the horizon."""
        return self.runs().where(F.coalesce(F.col("run_ts") > F.lit(self.head().horizon_ts), F.lit(True)))

    def snapshot_of(self, run_ts: datetime) -> DataFrame:
        """The rows of any run ever ingested."""
        at = self.head().horizon_ts
        if at is not None and run_ts <= at:
            return intervals.as_of(self.stretches(), run_ts)
        return self.log(self.runs().where(F.col("run_ts") == F.lit(run_ts)))

    def history(self) -> DataFrame:
        """The rows of every run ever ingested, replaced same-day runs included."""
        stored = self.log(self.stored_runs())
        if not self.head().stretches:
            return stored
        return stored.unionByName(intervals.decode(self.stretches(), self.runs_behind()))

    def quarantined(self, run_ts: datetime) -> DataFrame | None:
        """The rows of a visible run that were set aside, with their `reasons`, in the columns they came
        with; None if there are none, or none any more."""
        run = self.runs().where(F.col("run_ts") == F.lit(run_ts)).select("quarantine").first()
        if run is None or not run.quarantine or run.quarantine not in held(self, "intake"):
            return None
        return self.spark.read.parquet(f"{self.folder('intake', run.quarantine)}/kept=false")

    def unknown(self, run_ts: datetime) -> DataFrame:
        """Works of a visible run with fields that no column takes: work_id, region and the variant `fields`,
        to project with `variant_get`. Empty if there are none, or none any more."""
        run = self.runs().where(F.col("run_ts") == F.lit(run_ts)).select("unknown").first()
        if run is None or not run.unknown or run.unknown not in held(self, "unknown"):
            return self.spark.createDataFrame([], UNKNOWN_ROWS)
        return self.spark.read.schema(UNKNOWN_ROWS).parquet(self.folder("unknown", run.unknown))

    def observations(self) -> DataFrame:
        return R.observations(self.history(), F.col("run_ts"))

    def labelled(self) -> DataFrame:
        """Entities with status, latest progress and lifecycle label. A work that only a repeated run
        knew, and whose repetition left it out, has vanished."""
        labels = lifecycle.label_facts(self.facts(), R.SIGNATURE)
        rows = self.entities().join(labels, list(R.SIGNATURE), "left")
        return rows.withColumns({
            "status": F.coalesce("status", F.lit(R.GONE)), "label": F.when(F.col("status").isNull(), K.LABEL_GONE).otherwise(F.col("label")),
        })

    def search(self, query: str, regex: bool = True) -> DataFrame:
        """Labelled entities that match in one of the searched columns, by the commit's index
        (`index_search`) if it has one, else by a scan."""
        index = TrigramIndex(self.spark, self.folder("search", self.head().sequence))
        if not index.ready():
            return views.search(self.labelled(), query, views.SEARCHED, regex)
        return index.search(query, views.SEARCHED, regex)

    def wide(self, shown_runs: int = K.SHOWN_RUNS) -> DataFrame:
        """Labelled entities with one column per latest run; only those runs are read."""
        days = self.runs().groupBy("run_date").agg(F.max_by(F.struct("run_ts", "snapshots"), "run_ts").alias("r"))
        shown = days.select("r.*").orderBy(F.desc("run_ts")).limit(shown_runs).collect()
        at = self.head().horizon_ts
        stored = [r.snapshots for r in shown if at is None or r.run_ts > at]
        folders = self.spark.read.schema(with_sequence(SNAPSHOT_ROWS)).parquet(f"{self.root}/snapshots")
        recent = R.observations(folders.where(F.col("sequence").isin(stored)), F.col("run_ts"))
        for r in shown:
            if r.snapshots not in stored:
                recent = recent.unionByName(R.observations(intervals.as_of(self.stretches(), r.run_ts), F.col("run_ts")))
        columns = history.to_wide(recent, R.SIGNATURE, sorted(r.run_ts for r in shown))
        return self.labelled().join(columns, list(R.SIGNATURE), "left")


class Job:
    """One numbered change of the state: write tables, then commit."""

    def __init__(self, state: State, kind: str):
        if state.until is not None:
            raise ValueError("a past state does not change")
        self.state, self.kind, self.head = state, kind, state.head()
        self.sequence = self.head.sequence + 1
        self.written: dict[str, int] = {}

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Write a table under the job's number and read it back."""
        folder = self.state.folder(table, self.sequence)
        rows = df.select(*SCHEMAS[table].names).write.mode("overwrite").option("compression", "zstd")
        with job_settings(self.state.spark):
            rows.partitionBy(*PARTS.get(table, ())).parquet(folder)
        self.written[table] = self.sequence
        return self.state.spark.read.schema(SCHEMAS[table]).parquet(folder)

    def commit(self, runs: Sequence[dict[str, object]] = (), **run: object) -> None:
        """Make the job visible. `runs` are further runs it brings, each with what its row says."""
        pointers = {t: self.written.get(t, 0 if t == "snapshots" else self.head[t]) for t in TABLES}
        carried = {c: self.head[c] for c in ("stretches_since", "horizon_ts")}
        row = {**dict.fromkeys(COMMITS.names), **carried, **run, **pointers, "kind": self.kind}
        fields = [f for f in COMMITS.fields if f.name != "sequence"]
        rows = [tuple(r[f.name] for f in fields) for r in (row, *({**row, **other} for other in runs))]
        record = self.state.spark.createDataFrame(rows, T.StructType(fields))
        record.coalesce(1).write.mode("overwrite").parquet(self.state.folder("commits", self.sequence))


def merge_entities(old: DataFrame | None, new: DataFrame, late: bool = False) -> DataFrame:
    """Entities after a run. A late run (older than the newest) only fills gaps."""
    first = old is None
    if first:
        old = new.where(F.lit(False))
    if late:
        # Roles swapped: what is already known wins over the older dump.
        merged = R.merge_nonblank(R.match(new, old, whole=not first), [*MERGE_COLUMNS, "tag"], owned=("work_id",))
        return merged.withColumn("tag", or_empty(F.col("tag")))
    return R.merge_nonblank(R.match(old, new, whole=not first), MERGE_COLUMNS)


def next_facts(known: DataFrame, observed: DataFrame) -> DataFrame:
    """Facts after a run that is newer than all others and the first of its day."""
    keys = list(R.SIGNATURE)
    old = known.select(*keys, F.struct(*[c for c in known.columns if c not in keys]).alias("old"))
    new = observed.select(*keys, F.struct("pct", "pct_text").alias("new"))
    was, now = F.col("old"), F.col("new")
    return old.join(new, keys, "full_outer").select(
        *keys,
        now.isNotNull().alias("present"),
        was.isNotNull().alias("seen_before"),
        F.when(was["present"] & was["now_known"], was["pct_now"]).otherwise(was["last_known"]).alias("last_known"),
        now["pct"].alias("pct_now"),
        (now.isNotNull() & ~is_blank(now["pct_text"])).alias("now_known"),
        F.when(was["present"], was["pct_now"]).alias("pct_before"),
    )


def ingest_run(
    state: State,
    snapshot: DataFrame,
    run_ts: datetime,
    entries: DataFrame | None = None,
    regions: Sequence[str] = (),
    counts: Observation | None = None,
    beside: Callable[[Job, dict[str, object]], dict[str, object]] | None = None,
    **noted: object,
) -> None:
    """Fold one snapshot into the state; an unusable snapshot raises before any visible change.

    The deduplicated snapshot is written first and read back, so the dump is worked through once
    however many results are drawn from it. `counts` observes a larger source the snapshot comes
    from, `noted` goes into the commit row, and so does what `beside` returns, which is called with the
    job and the counts before the commit and may write folders of its own. Works that the stored deny-list, or `entries`, denies are tagged.
    """
    require_key(snapshot, "work_id")
    job = Job(state, "run")
    columns = [*ENTITY_COLUMNS, PROGRESS]
    batch = R.one_row_per_work(as_text(align_schema(snapshot, columns).select(*columns)))
    stored = job.write("snapshots", batch.withColumn("run_ts", F.lit(run_ts)))
    own = stored.agg(F.count("*")).first()[0]
    if not own:
        raise ValueError("snapshot has no rows")

    newest = state.newest_run()
    late = newest is not None and run_ts < newest
    first = not job.head.entities
    known = None if first else state.entities().select(*R.SIGNATURE, *ENTITY_COLUMNS)
    entities = merge_entities(known, stored.drop("run_ts", PROGRESS), late)
    listed = state.entries() if entries is None and job.head.entries else entries
    if listed is not None:
        entities = denylist.tag_denied(entities, listed)
    job.write("entities", entities)

    observed = R.observations(stored, F.col("run_ts"))
    if newest is None or run_ts.date() > newest.date():
        job.write("facts", next_facts(state.facts(), observed))
        moved = {}
    else:
        moved = _facts_with_run(state, job, stored, run_ts)

    found = counts.get if counts is not None else {"updated_at": run_ts, "total_rows": own, "kept_rows": own, "corrupt_rows": 0}
    if beside is not None:
        noted = {**noted, **beside(job, found)}
    job.commit(run_ts=run_ts, run_date=run_ts.date(), regions=", ".join(regions), **{**found, **moved, **noted})


def ingest_checked(
    state: State,
    rows: DataFrame,
    run_ts: datetime,
    rules: Sequence[quarantine.Rule],
    key: str = "work_id",
    order_by: Sequence[str] = ("road_code",),
    duplicates: float = 1.0,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    **options,
) -> dict[str, int]:
    """`ingest_run` for rows that have to pass `rules` and to have a key of their own.

    The rows are read once and written once, kept ones and those set aside with their reasons. If more
    than a rule's limit (for repeated keys: the share `duplicates`) are set aside, `LimitExceeded` is
    raised and nothing is committed. `prepare` makes the snapshot of the kept rows. Returns the
    counts: rows_read = rows_kept + rows set aside; a row counts for each of its reasons.
    """
    require_key(rows, key)
    sequence = state.head().sequence + 1
    folder = state.folder("intake", sequence)
    found = Observation()
    sorted_out = quarantine.sort_out(rows, rules, strip(F.col(key).cast("string")), [c for c in order_by if c in rows.columns])
    counted = sorted_out.observe(found, *quarantine.reason_counts(rules, key=True))
    apart = counted.withColumn("kept", F.size(quarantine.REASONS) == 0).write.mode("overwrite").option("compression", "zstd").partitionBy("kept")
    with job_settings(state.spark):
        apart.parquet(folder)
    counts = found.get
    quarantine.check_limits(counts, rules, duplicates)
    if not counts["rows_kept"]:
        raise ValueError("snapshot has no rows")
    kept = state.spark.read.parquet(f"{folder}/kept=true").drop(quarantine.REASONS)
    aside = counts["rows_read"] - counts["rows_kept"]
    noted = {"quarantine": sequence if aside else None, "quarantined_rows": aside}
    ingest_run(state, kept if prepare is None else prepare(kept), run_ts, **noted, **options)
    delete(state, [f"{folder}/kept=true"])
    return counts


def _facts_with_run(state: State, job: Job, stored: DataFrame, run_ts: datetime) -> dict[str, object]:
    """Write the facts after a run that is late, repeated or not the first of its day, merged from the
    records of the horizon, of the stored snapshots and of the run; returns what the commit needs."""
    at, moved = job.head.horizon_ts, {}
    this = state.spark.createDataFrame([(run_ts,)], "run_ts timestamp")
    runs = state.runs().select("run_ts").union(this).distinct()
    behind = at is not None and run_ts <= at
    horizon = state.horizon()
    if at is not None and run_ts.date() <= at.date():
        # The run is behind the horizon, or decides which run of the horizon's day counts.
        stretches = state.stretches()
        if behind:
            known = runs.where(F.col("run_ts") <= F.lit(at))
            inserted = intervals.with_run(stretches, stored, run_ts, R.SIGNATURE, known)
            written = job.write("stretches", inserted.withColumn("open", F.col("valid_to") == F.lit(at)))
            stretches, moved = written.drop("open"), {"stretches_since": job.sequence}
        horizon = job.write("horizon", lifecycle.stretch_records(_with_progress(stretches), runs, R.SIGNATURE))

    others = state.stored_runs().where(F.col("run_ts") != F.lit(run_ts))
    blocks = R.observations(state.log(others), F.col("run_ts"))
    if not behind:
        blocks = blocks.unionByName(R.observations(stored, F.col("run_ts")))
    job.write("facts", _merged_facts(runs, horizon, blocks))
    return moved


def _with_progress(stretches: DataFrame) -> DataFrame:
    return stretches.withColumns({"pct_text": F.col(PROGRESS), "pct": parse_pct(F.col(PROGRESS))})


def _merged_facts(runs: DataFrame, horizon: DataFrame, blocks: DataFrame) -> DataFrame:
    """Facts of all runs, from the horizon's records and the observations of the newer runs."""
    two = history.latest_runs(history.last_run_of_day(runs), 2).orderBy("rank").collect()
    newest, before = two[0].run_ts, two[1].run_ts if len(two) > 1 else None
    is_newest = F.col("run_ts") == F.lit(newest)
    own = lifecycle.fact_records(blocks.where(~is_newest), runs, R.SIGNATURE)
    records = lifecycle.merge_records(horizon.unionByName(own), R.SIGNATURE)
    return lifecycle.facts_of(records, blocks.where(is_newest), F.lit(before).cast("timestamp"), R.SIGNATURE)


def refresh(
    state: State,
    raw: DataFrame,
    run_ts: datetime,
    updated_at: str = "updated_at",
    entries: DataFrame | None = None,
    regions: Sequence[str] = K.REGIONS,
    minimum: float = K.MIN_AMOUNT,
) -> None:
    """One scheduled run: landed raw works -> scope and amount filter -> snapshot -> state.

    `updated_at` names the raw column that tells how fresh the source is. The raw rows are counted
    while the snapshot is written, in the same scan. Lines that could not be read are counted
    as corrupt and go no further. Of works with unknown fields (`scan_works_open`) the run row names these
    with their kinds; only a run that has some is scanned again, to store them.
    """
    counts = Observation()
    readable = raw if CORRUPT in raw.columns else raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    broken = F.col(CORRUPT).isNotNull()
    amount = parse_amount(F.col("importo_lav_totale"))
    in_scope = ~broken & F.coalesce(F.col("_regione").isin(*regions), F.lit(False))
    kept = in_scope & (F.coalesce(amount, F.lit(0.0)) >= minimum)
    opened = UNKNOWN in raw.columns
    found = run_counts(in_scope, kept, broken, updated_at)
    if opened:
        readable = readable.withColumn(UNKNOWN, F.when(kept, F.col(UNKNOWN)))
        found.append(unknown_fields())

    def store_unknown(job: Job, known: dict[str, object]) -> dict[str, object]:
        if not known["unknown_fields"]:
            return {}
        rows = readable.where(F.col(UNKNOWN).isNotNull())
        rows = rows.select(or_empty(strip(F.col("id"))).alias("work_id"), F.col("_regione").alias("region"), F.col(UNKNOWN).alias("fields"))
        rows.write.mode("overwrite").parquet(state.folder("unknown", job.sequence))
        return {"unknown": job.sequence}

    counted = readable.observe(counts, *found)
    snapshot = project_snapshot(counted.where(kept).drop(UNKNOWN))
    ingest_run(state, snapshot, run_ts, entries, regions, counts, store_unknown if opened else None)


def save_tags(state: State, edits: DataFrame, today: date) -> dict[str, int]:
    """Store tag edits (work_id, seq, new_tag): rows get their tag, the deny-list follows.

    Projects of rows tagged as denied join the list, those of rows tagged otherwise leave it.
    Returns how many entries were added and removed.
    """
    job = Job(state, "tags")
    entities = state.entities()
    last = denylist.latest_edits(edits.select("work_id", "seq", "new_tag"))
    edited = lookup_join(entities, last, ["work_id"], "inner")
    edited = edited.where(or_empty(F.col("tag")) != or_empty(F.col("new_tag")))
    current = state.entries()
    listed = denylist.compact(denylist.sync_with_edits(current, edited, today), today, None)
    stored = job.write("entries", listed)
    job.write("entities", denylist.apply_edits(entities, edits))
    job.commit()
    return denylist.change_counts(current, stored)


def deny_rows(state: State, selected: DataFrame, today: date) -> dict[str, int]:
    """Put the projects of selected rows on the deny-list and tag every work the list denies."""
    job = Job(state, "deny")
    current = state.entries()
    added = denylist.add(current, denylist.entries_from_rows(selected), today).withColumn("seq", F.lit(0))
    stored = job.write("entries", denylist.compact(added, today, None))
    job.write("entities", denylist.tag_denied(state.entities(), stored.withColumn("seq", F.lit(0)), only_blank=False))
    job.commit()
    return denylist.change_counts(current, stored)


def undeny(state: State, projects: DataFrame, pairs: DataFrame | None = None) -> int:
    """Take all entries of the given projects (project_key), and the exact pairs (project_key, region), off
    the deny-list; tags stay as they are. Returns how many entries went."""
    job = Job(state, "undeny")
    current = state.entries()
    none = current.where(F.lit(False)).select("project_key", "region")
    stored = job.write("entries", denylist.remove(current, projects, none if pairs is None else pairs))
    job.commit()
    return denylist.change_counts(current, stored)["removed"]


def ingest_new_days(state: State, landed: Mapping[datetime, DataFrame], **options) -> list[datetime]:
    """`ingest_run` for the snapshots of days that the history does not have yet, oldest first; returns
    their times. Snapshots of a day that it has are left alone."""
    if not landed:
        return []
    times = state.spark.createDataFrame([(t, t.date()) for t in landed], "run_ts timestamp, run_date date")
    new = sorted(r.run_ts for r in history.pending_runs(times, state.runs()).collect())
    for run_ts in new:
        ingest_run(state, landed[run_ts], run_ts, **options)
    return new


def enrich(
    state: State,
    pages: DataFrame,
    gazetteer: DataFrame,
    keys: DataFrame | None = None,
    force: bool = False,
) -> dict[str, int]:
    """Fill the works of requested projects from registry pages, the cache and a gazetteer.

    `pages` (project_key, html) are those landed for this call, `keys` (project_key) the requested
    projects, by default all that are not denied. Only the keys that the cache lacks, or with
    `force` all that need a record, are taken from the pages; an empty page changes nothing.
    Returns the counters of the work list, the fields written and the coordinates found.
    """
    job = Job(state, "enrich")
    entities = state.entities()
    wanted = E.wanted_keys(entities) if keys is None else E.wanted_keys(keys, tag=None)
    flagged = E.worklist(entities, force, wanted)
    needed = E.wanted_keys(flagged.where("needs_record"), tag=None)
    to_fetch = needed if force else E.missing_keys(needed, state.cache())
    cache = job.write("cache", E.upsert_cache(state.cache(), fetched_records(pages, to_fetch), E.empty_record()))
    filled = E.fill_coordinates(E.safe_write(flagged, cache, place=True), gazetteer, cache)
    work, done = Observation(), Observation()
    counted = filled.observe(
        done,
        F.coalesce(F.sum("fields_written"), F.lit(0)).alias("fields_written"),
        F.count_if(F.col("fields_written") > 0).alias("rows_written"),
        F.count_if("coordinate_found").alias("coordinates_found"),
    ).observe(
        work,
        F.count_if("requested").alias("rows_touched"),
        F.count_if("needs_record").alias("rows_need_record"),
        F.count_if("needs_coordinate").alias("rows_need_coordinate"),
        F.count_if("complete").alias("rows_complete"),
    )
    job.write("entities", counted)
    job.commit()
    return {**work.get, **done.get}


def fetched_records(pages: DataFrame, keys: DataFrame) -> DataFrame:
    """Records of the pages of the given keys, one row per key."""
    chosen = lookup_join(pages.select("project_key", "html"), keys, ["project_key"], "left_semi")
    lined = chosen.withColumn("lines", html.text_lines(F.col("html")))
    fields = html.registry_fields(F.col("html"), F.col("lines"), F.col("project_key"))
    records = lined.select("project_key", *[fields[c].alias(c) for c in RECORD_COLUMNS])
    return records.groupBy("project_key").agg(*[F.max(c).alias(c) for c in RECORD_COLUMNS])


def refresh_and_enrich(state: State, raw: DataFrame, run_ts: datetime, pages: DataFrame, gazetteer: DataFrame, **options) -> dict[str, int] | None:
    """`refresh`, then `enrich` as well as it can: a failed enrichment leaves the run as it is."""
    refresh(state, raw, run_ts, **options)
    try:
        return enrich(state, pages, gazetteer)
    except Exception as e:  # the run is stored already and must not be undone
        state.spark.sparkContext._jvm.org.slf4j.LoggerFactory.getLogger("snaptrack").warn(f"enrichment failed: {e}")
        return None


def index_search(state: State) -> None:
    """Index the labelled entities of the newest commit for `State.search`. The entities change with every
    commit, so an index serves its own; those of commits that are gone go with `drop_expired_versions`."""
    sequence = state.head().sequence
    if not sequence:
        raise LookupError("there is no commit yet")
    index = TrigramIndex(state.spark, state.folder("search", sequence))
    if not index.ready():
        index.add(state.labelled(), views.SEARCHED)


def delete(state: State, folders: Sequence[str]) -> int:
    hadoop = state.spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = state.spark.sparkContext._jsc.hadoopConfiguration()
    paths = [hadoop.Path(f) for f in folders]
    return sum(bool(p.getFileSystem(conf).delete(p, True)) for p in paths)


def _exists(state: State, folder: str) -> bool:
    path = state.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(state.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def pin(state: State, sequence: int) -> None:
    """Keep all that the state as of a commit needs, until `unpin`."""
    state.at(sequence)
    marker = state.spark.createDataFrame([(sequence,)], "pinned long")
    marker.coalesce(1).write.mode("overwrite").parquet(state.folder("pins", sequence))


def unpin(state: State, sequence: int) -> None:
    delete(state, [state.folder("pins", sequence)])


def _unpinned(state: State, folders: Sequence[str]) -> list[str]:
    """Those of the folders that no pinned commit needs; few commits are pinned."""
    needed = set().union(*(State(state.spark, state.root, n).needs() for n in held(state, "pins")))
    return [f for f in folders if f not in needed]


def held(state: State, table: str) -> list[int]:
    """Numbers of the folders that are there."""
    hadoop = state.spark.sparkContext._jvm.org.apache.hadoop.fs
    top = hadoop.Path(f"{state.root}/{table}")
    fs = top.getFileSystem(state.spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith("sequence="))


def drop_expired_versions(state: State, keep: int = K.RETAINED_RUNS) -> int:
    """Delete all but the newest versions of entities, facts, deny-list, cache and horizon; returns how
    many. Of the stretches those go that only an older horizon had; ended ones stay. Search indexes of
    commits before the newest `keep` go as well.

    Only folders that still exist are listed, so old jobs cost nothing.
    """
    head = state.head()

    def old(table: str) -> list[int]:
        return [k for k in held(state, table) if k < (head[table] or 0)][: -(keep - 1) or None]

    expired = [state.folder(t, n) for t in ("entities", "facts", "entries", "cache", "horizon") for n in old(t)]
    since = head.stretches_since or 0
    stretches = [f"{state.folder('stretches', n)}/open=true" if n >= since else state.folder("stretches", n) for n in old("stretches")]
    delete(state, [state.folder("search", n) for n in held(state, "search") if n <= head.sequence - keep])
    return delete(state, _unpinned(state, expired + stretches))


def drop_expired_runs(state: State, keep: int = K.RETAINED_RUNS) -> int:
    """Delete the stored snapshots of all runs but the newest `keep` (and those replaced by a repeated
    run) with the rows set aside and the unknown fields of those runs; returns how many folders of snapshots went.

    Nothing is lost: the runs are folded into the stretches and the horizon first, in a commit of
    their own, so entities, labels, `history` and what later runs make of them stay as they are.
    """
    if keep < 1:
        raise ValueError("the newest run stays")
    stored = state.stored_runs().orderBy(F.desc("run_ts")).select("run_ts", "snapshots").collect()
    if stored[keep:]:
        _fold(state, [r.snapshots for r in stored[keep:]], stored[keep].run_ts)
    kept = {r.snapshots for r in stored[:keep]}
    beside = [state.folder(t, n) for t in ("intake", "unknown") for n in held(state, t) if n not in kept]
    delete(state, _unpinned(state, beside))
    return delete(state, _unpinned(state, [state.folder("snapshots", n) for n in held(state, "snapshots") if n not in kept]))


def _fold(state: State, folders: Sequence[int], until: datetime) -> None:
    """Move the horizon to the run `until`; the snapshots in `folders` are those of all runs up to it
    that are newer than the old horizon."""
    job = Job(state, "fold")
    runs = state.runs().select("run_ts")
    wanted = state.runs().where(F.col("snapshots").isin(list(folders)))
    rows = state.log(wanted)
    known = state.open_stretches().unionByName(intervals.single_runs(rows))
    grown = intervals.joined(known, R.SIGNATURE, runs.where(F.col("run_ts") <= F.lit(until)))
    job.write("stretches", grown.withColumn("open", F.col("valid_to") == F.lit(until)))
    own = lifecycle.fact_records(R.observations(rows, F.col("run_ts")), runs, R.SIGNATURE)
    job.write("horizon", lifecycle.merge_records(state.horizon().unionByName(own), R.SIGNATURE))
    job.commit(horizon_ts=until, stretches_since=job.head.stretches_since or job.sequence)


def rebuild_entities(log: DataFrame) -> DataFrame:
    """Entities from a full snapshot log (snapshot columns and run_ts).

    Folding run after run leaves, per entity and column, the last value that was not blank, or
    the first run's value if there was none: one aggregation instead of one join per run.
    """

    def last_value(c: str) -> Column:
        at = F.when(~is_blank(F.col(c), K.BLANK_COORDINATE), F.col("run_ts"))
        return F.coalesce(F.max_by(c, at), F.min_by(c, "run_ts")).alias(c)

    return R.with_signature(log).groupBy(*R.SIGNATURE).agg(
        F.min_by("work_id", "run_ts").alias("work_id"),
        F.lit(K.TAG_OPEN).alias("tag"),
        *[last_value(c) for c in MERGE_COLUMNS],
    )
