"""Joins of many rows with a lookup that holds one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join rows to a lookup with at most one row per key; any key may hold most of the rows.

    Spark broadcasts the lookup when it measures it small. Otherwise both sides are shuffled
    and the adaptive skew join splits the row side of a hot key. It can only do so if the
    lookup is shuffled for this very join, which a lookup fresh from a groupBy is not: its
    rows already sit where the grouping put them. The key's hash as an additional join key
    makes Spark shuffle the (already reduced) lookup once more.
    """
    hashed = F.xxhash64(*on)
    left, right = rows.withColumn("_hash", hashed), lookup.withColumn("_hash", hashed)
    return left.join(right, ["_hash", *on], how).drop("_hash")
