"""Match a new snapshot with the entities known so far and merge them.

Both sides hold at most one row per row key when they meet (`keep_first`), so the full outer
join has no hot key whatever the input looked like.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrack import constants as K
from snaptrack.functions.numbers import parse_pct
from snaptrack.functions.text import is_blank, normalise, or_empty, strip
from snaptrack.operators.dedupe import keep_first
from snaptrack.operators.packing import only_texts, pack, with_unpacked

SIGNATURE = ("sig_project", "sig_region", "sig_id")
BOTH, NEW, GONE = "both", "new", "gone"


def with_signature(
    df: DataFrame, project: str = "project_key", region: str = "region", key: str = "work_id"
) -> DataFrame:
    """Add the three-part match key unless it is there; only the region matches in any case."""
    if set(SIGNATURE) <= set(df.columns):
        return df
    return df.withColumns(
        {
            "sig_project": or_empty(strip(F.col(project))),
            "sig_region": normalise(F.col(region)),
            "sig_id": or_empty(strip(F.col(key))),
        }
    )


def one_row_per_work(
    snapshot: DataFrame, key: str = "work_id", order_by: Sequence[str] = ("road_code",)
) -> DataFrame:
    """Strip the row key and keep the first row per key in a total order; adds the signature."""
    if set(SIGNATURE) <= set(snapshot.columns):
        first = keep_first(snapshot, ["sig_id"], list(order_by))
    else:
        # The rest of the signature follows from the row and need not be shuffled.
        keyed = snapshot.withColumn("sig_id", or_empty(strip(F.col(key))))
        first = with_signature(keep_first(keyed, ["sig_id"], list(order_by)).drop("sig_id"), key=key)
    return first.withColumn(key, F.col("sig_id"))


def _side(df: DataFrame, flag: str, texts: Sequence[str]) -> DataFrame:
    others = [c for c in df.columns if c not in (*SIGNATURE, *texts)]
    return with_signature(df).select(
        *SIGNATURE,
        (pack(texts) if texts else F.lit(True)).alias(flag),
        *[F.col(c).alias(f"{flag}_{c}") for c in others],
    )


def match(old: DataFrame, new: DataFrame, whole: bool = False) -> DataFrame:
    """Full outer join on the signature: signature, status, old_* and new_* columns.

    `whole` says that all columns are wanted: rows of texts alone are then shuffled packed.
    """
    sides = {"old": old, "new": new}
    rest = {flag: [c for c in df.columns if c not in SIGNATURE] for flag, df in sides.items()}
    texts = {flag: rest[flag] if whole and only_texts(df, rest[flag]) else [] for flag, df in sides.items()}
    one, two = (_side(df, flag, texts[flag]) for flag, df in sides.items())
    joined = one.join(two, list(SIGNATURE), "full_outer")
    status = (
        F.when(F.col("old").isNull(), F.lit(NEW))
        .when(F.col("new").isNull(), F.lit(GONE))
        .otherwise(F.lit(BOTH))
    )
    found = joined.withColumn("status", status)
    for flag in sides:
        found = with_unpacked(found, flag, texts[flag], f"{flag}_") if texts[flag] else found.drop(flag)
    return found


def keys_in_both(old: DataFrame, new: DataFrame) -> DataFrame:
    return _signatures(old).intersect(_signatures(new))


def keys_only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    return _signatures(left).join(_signatures(right), list(SIGNATURE), "left_anti")


def append_new(old: DataFrame, new: DataFrame, columns: Sequence[str], **added: Column) -> DataFrame:
    """All old rows, and the new rows whose signature no old row has, with the columns `added`
    (null in old rows); old columns that new rows lack are null there."""
    rows = with_signature(new).join(_signatures(old), list(SIGNATURE), "left_anti")
    fresh = rows.select(*columns, *[c.alias(n) for n, c in added.items()])
    return old.unionByName(fresh, allowMissingColumns=True)


def _signatures(df: DataFrame) -> DataFrame:
    return with_signature(df).select(*SIGNATURE).distinct()


def status_counts(matched: DataFrame) -> DataFrame:
    return matched.groupBy("status").agg(F.count("*").alias("works"))


def updates(column: str) -> Column:
    """Does the new value of a matched row replace the old one?"""
    return ~is_blank(F.col(f"new_{column}"), K.BLANK_COORDINATE)


def merge_nonblank(
    matched: DataFrame, columns: Sequence[str], owned: Sequence[str] = ("work_id", "tag")
) -> DataFrame:
    """Merged entities: a blank never replaces a value, owned columns never change.

    New works enter as they are, vanished works stay as they were.
    """
    status = F.col("status")

    def merged(c: str) -> Column:
        old, new = F.col(f"old_{c}"), F.col(f"new_{c}")
        return F.when(
            (status == NEW) | ((status == BOTH) & updates(c)), new
        ).otherwise(old)

    def kept(c: str) -> Column:
        new = F.col(f"new_{c}") if f"new_{c}" in matched.columns else F.lit("")
        old = F.col(f"old_{c}") if f"old_{c}" in matched.columns else F.lit("")
        return F.when(status == NEW, or_empty(new)).otherwise(or_empty(old))

    return matched.select(
        *SIGNATURE,
        "status",
        *[kept(c).alias(c) for c in owned],
        *[merged(c).alias(c) for c in columns],
    )


def merge_counters(matched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cells updated and preserved over the works present on both sides."""
    updated = reduce(Column.__add__, [updates(c).cast("long") for c in columns])
    both = matched.where(F.col("status") == BOTH)
    cells = F.lit(len(columns)).cast("long")
    return both.agg(
        F.coalesce(F.sum(updated), F.lit(0)).cast("long").alias("cells_updated"),
        F.coalesce(F.sum(cells - updated), F.lit(0)).cast("long").alias("cells_preserved"),
    )


def observations(
    snapshot: DataFrame, run_ts: Column, progress: str = "progress"
) -> DataFrame:
    """One history row per work of a run; `snapshot` holds one row per work."""
    return with_signature(snapshot).select(
        *SIGNATURE,
        run_ts.cast("timestamp").alias("run_ts"),
        run_ts.cast("timestamp").cast("date").alias("run_date"),
        F.col(progress).alias("pct_text"),
        parse_pct(F.col(progress)).alias("pct"),
    )
