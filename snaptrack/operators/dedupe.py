"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrack.operators.packing import only_texts, pack, with_unpacked


def _one_per_key(pick, df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    order = [*order_by, *[c for c in rest if c not in order_by]]
    if only_texts(df, order) and not set(keys) & set(order):
        one = df.groupBy(*keys).agg(pick(pack(order)).alias("_row"))
        return with_unpacked(one, "_row", order).select(*df.columns)
    row = pick(F.struct(*order)).alias("_row")
    one = df.groupBy(*keys).agg(row)
    return one.select(*[c if c in keys else F.col(f"_row.{c}") for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The smallest row per key, by `order_by` and then by all remaining columns.

    The order is total, so the result does not depend on file order or partitioning. It is a
    minimum, not a ranking: each task reduces its own rows before the shuffle, and a key that
    holds most of the table sends one row per task instead of filling one window. Rows of
    texts alone travel packed (`packing`), which halves what is shuffled.
    """
    return _one_per_key(F.min, df, keys, order_by)


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The largest row per key, by `order_by` and then by all remaining columns."""
    return _one_per_key(F.max, df, keys, order_by)
