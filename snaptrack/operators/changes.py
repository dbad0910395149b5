"""What changed between two versions of a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADDED, CHANGED, GONE = "added", "changed", "gone"


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key whose row differs: keys, kind, old and new row, and the names of the columns that
    differ (of both versions' common columns; none for rows added or gone).

    One full outer join by the keys; equal rows go no further. Keys are not null and name one row each.
    """
    values = [c for c in before.columns if c in after.columns and c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in values])
    old, new = before.select(*keys, row.alias("old")), after.select(*keys, row.alias("new"))
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    kind = F.when(F.col("old").isNull(), F.lit(ADDED)).when(F.col("new").isNull(), F.lit(GONE)).otherwise(F.lit(CHANGED))

    def differs(c: str) -> Column:
        return F.when(both & ~F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")), F.lit(c))

    joined = old.join(new, list(keys), "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
    return joined.select(*keys, kind.alias("kind"), F.array_compact(F.array(*map(differs, values))).alias("columns"), "old", "new")


def apply_feed(rows: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`rows` (the older version) with the changes of a feed: the newer version."""
    kept = rows.join(feed.select(*keys), list(keys), "left_anti")
    values = [c for c in rows.columns if c not in keys]
    new = feed.where(F.col("kind") != GONE).select(*keys, *[F.col(f"new.`{c}`").alias(c) for c in values])
    return kept.unionByName(new)
