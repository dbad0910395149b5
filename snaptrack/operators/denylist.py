"""Deny-list: projects the user discarded, matched on project key and region.

Entries are rows of (project_key, region, contractor, description, added_on) plus `seq`, the
input order that decides which duplicate is kept. Nothing is hinted for broadcast here: Spark
broadcasts a deny-list whose measured size is small and shuffles it otherwise.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrack import constants as K
from snaptrack.functions.text import is_blank, normalise, or_empty, strip
from snaptrack.operators.dedupe import keep_first, keep_last
from snaptrack.operators.joins import lookup_join
from snaptrack.schemas import DENY_COLUMNS

_PAIR = ("k_project", "k_region")


def _keyed(entries: DataFrame) -> DataFrame:
    return entries.withColumns(
        {
            "k_project": or_empty(strip(F.col("project_key"))),
            "k_region": normalise(F.col("region")),
        }
    )


def entries_of(document: Column) -> Column:
    """Entries of one parsed document of any of the three shapes, as an array of structs.

    A list under `entries` wins even when empty; an empty `cups` falls through to `ids`.
    """
    legacy = F.when(F.size(document["cups"]) > 0, document["cups"]).otherwise(document["ids"])
    none = F.lit("")
    from_keys = F.transform(
        F.transform(legacy, strip),
        lambda key: F.struct(
            key.alias("cup"), none.alias("regione"), none.alias("impresa"),
            none.alias("descrizione"), none.alias("added_at"),
        ),
    )
    entries = F.coalesce(document["entries"], from_keys)
    return F.filter(entries, lambda e: or_empty(e["cup"]) != "")


def explode_entries(documents: DataFrame, document: str, *keep: str) -> DataFrame:
    return documents.select(*keep, F.explode(entries_of(F.col(document))).alias("e")).select(
        *keep,
        F.col("e.cup").alias("project_key"),
        or_empty(F.col("e.regione")).alias("region"),
        or_empty(F.col("e.impresa")).alias("contractor"),
        or_empty(F.col("e.descrizione")).alias("description"),
        or_empty(F.col("e.added_at")).alias("added_on"),
    )


def compact(
    entries: DataFrame, today: date, description_length: int | None = K.DESCRIPTION_LENGTH
) -> DataFrame:
    """Form in which the list is exported: trimmed, one entry per key, sorted, descriptions shortened
    to `description_length` characters (None keeps them whole, as the state's own table does)."""
    first = keep_first(
        _keyed(entries).where(F.col("k_project") != ""), _PAIR, ["seq"]
    )

    def stripped(c: str) -> Column:
        return or_empty(strip(F.col(c)))

    added_on = stripped("added_on")
    return first.select(
        F.col("k_project").alias("project_key"),
        stripped("region").alias("region"),
        stripped("contractor").alias("contractor"),
        (
            stripped("description") if description_length is None
            else F.substring(stripped("description"), 1, description_length)
        ).alias("description"),
        F.when(added_on == "", F.lit(today.isoformat())).otherwise(added_on).alias("added_on"),
    ).orderBy("project_key", "region")


def new_entries(current: DataFrame, candidates: DataFrame, today: date) -> DataFrame:
    """Candidates with a usable key that the list does not hold yet, first of each key."""
    usable = _keyed(candidates).where(~F.col("k_project").isin(*K.BLANK_TEXTS))
    known = _keyed(current).select(*_PAIR).distinct()
    added = keep_first(usable, _PAIR, ["seq"]).join(known, list(_PAIR), "left_anti")
    return added.withColumn("added_on", F.lit(today.isoformat())).select(*DENY_COLUMNS, "seq")


def add(current: DataFrame, candidates: DataFrame, today: date) -> DataFrame:
    """The list with its new entries; `added` marks them."""
    old = current.select(*DENY_COLUMNS, F.lit(False).alias("added"))
    new = new_entries(current, candidates, today).select(*DENY_COLUMNS, F.lit(True).alias("added"))
    return old.unionByName(new)


def change_counts(before: DataFrame, after: DataFrame) -> dict[str, int]:
    """How many keys joined and left the list."""
    row = changes(before, after).first()
    return {"added": row.added, "removed": row.removed}


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: keys that joined and keys that left the list."""
    old = _keyed(before).select(*_PAIR).distinct().withColumn("_old", F.lit(True))
    new = _keyed(after).select(*_PAIR).distinct().withColumn("_new", F.lit(True))
    return old.join(new, list(_PAIR), "full_outer").agg(
        F.count_if(F.col("_old").isNull()).alias("added"), F.count_if(F.col("_new").isNull()).alias("removed")
    )


def remove(current: DataFrame, projects: DataFrame, pairs: DataFrame) -> DataFrame:
    """Drop all entries of the given project keys and the exact (project, region) pairs."""
    bare = projects.select(strip(F.col("project_key")).alias("k_project")).distinct()
    exact = _keyed(pairs).select(*_PAIR).distinct()
    left = lookup_join(_keyed(current), bare, ["k_project"], "left_anti")
    return lookup_join(left, exact, _PAIR, "left_anti").select(*current.columns)


def with_denied(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Add `denied`: same project key and same region, a blank region on either side matching all.

    The "blank matches all" rule is answered from one flag per project instead of comparing a
    row with every entry of its project, so both joins are equi-joins on unique keys: they
    stay hash joins, never multiply rows, and a project with many rows or many entries costs
    no more per row than any other.
    """
    listed = _keyed(entries).where(F.col("k_project") != "")
    by_project = listed.groupBy("k_project").agg(
        F.max(F.col("k_region") == "").alias("any_region")
    )
    by_pair = (
        listed.where(F.col("k_region") != "").select(*_PAIR).distinct()
        .withColumn("same_region", F.lit(True))
    )
    joined = lookup_join(lookup_join(_keyed(rows), by_project, ["k_project"]), by_pair, _PAIR)
    denied = F.col("any_region").isNotNull() & (
        F.col("any_region") | (F.col("k_region") == "") | F.col("same_region").isNotNull()
    )
    return joined.select(*rows.columns, F.coalesce(denied, F.lit(False)).alias("denied"))


def tag_denied(rows: DataFrame, entries: DataFrame, only_blank: bool = True) -> DataFrame:
    """Tag denied rows; by default a tag the user has set is left alone."""
    denied = F.col("denied")
    if only_blank:
        denied = denied & (or_empty(strip(F.col("tag"))) == "")
    return (
        with_denied(rows, entries)
        .withColumn("tag", F.when(denied, F.lit(K.TAG_DENIED)).otherwise(F.col("tag")))
        .select(*rows.columns)
    )


def entries_from_rows(rows: DataFrame) -> DataFrame:
    """Selected entity rows as deny-list candidates; rows without a usable key are skipped."""
    columns = ("project_key", "region", "contractor", "description")
    return rows.where(~is_blank(F.col("project_key"))).select(
        *[or_empty(strip(F.col(c))).alias(c) for c in columns], "seq"
    )


def latest_edits(edits: DataFrame, key: str = "work_id") -> DataFrame:
    """One edit per row key, the last by `seq`."""
    return keep_last(edits, [key], ["seq"])


def apply_edits(rows: DataFrame, edits: DataFrame, key: str = "work_id") -> DataFrame:
    """Write user tags by row key (every row of that key); edits: key, seq, new_tag."""
    last = latest_edits(edits.select(key, "seq", "new_tag"), key).select(key, "new_tag")
    return (
        lookup_join(rows, last, [key])
        .withColumn("tag", F.coalesce(F.col("new_tag"), F.col("tag")))
        .select(*rows.columns)
    )


def sync_with_edits(
    current: DataFrame, edited: DataFrame, today: date
) -> DataFrame:
    """Follow tag edits: rows tagged as denied join the list, rows tagged otherwise leave it.

    `edited` holds the changed rows with their `new_tag` and `seq`.
    """
    denied = F.col("new_tag") == K.TAG_DENIED
    joining = entries_from_rows(edited.where(denied))
    leaving = entries_from_rows(edited.where(~denied))
    listed = current.unionByName(
        new_entries(current, joining, today), allowMissingColumns=True
    )
    none = leaving.where(F.lit(False))
    return remove(listed, none, leaving)
