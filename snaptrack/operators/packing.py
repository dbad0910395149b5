"""Rows of texts as one text, while they are shuffled.

A row of thirty short columns spends more on the places of its columns than on their text. `pack` joins
the texts of a row, each ended by a character that sorts before all others but a null's, and `unpack` takes them apart
again, nulls, blanks and control characters included. Packed rows are equal where all columns are, and
sort as the columns do one after the other, nulls first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Alone for a null; behind every text; in front of what stands for one of the three.
_NULL, _END, _MARK = "\x00", "\x01", "\x02"
_ESCAPED = ((_MARK, _MARK + "\x05"), (_END, _MARK + "\x04"), (_NULL, _MARK + "\x03"))


def only_texts(df: DataFrame, columns: Sequence[str]) -> bool:
    """Can these columns be packed, and are they enough to be worth it?"""
    kinds = dict(df.dtypes)
    return len(columns) > 4 and all(kinds.get(c) == "string" for c in columns)


def pack(columns: Sequence[str]) -> Column:
    """The texts of a row as one; never null. Few rows have texts to be escaped: only these go through the
    lambda, which also keeps the generated code in methods small enough to be compiled."""
    texts = [F.col(f"`{c}`") for c in columns]

    def written(text: Column) -> Column:
        for plain, short in _ESCAPED:
            text = F.replace(text, F.lit(plain), F.lit(short))
        return F.coalesce(text, F.lit(_NULL))

    escaped = F.concat(F.concat_ws(_END, F.transform(F.array(*texts), written)), F.lit(_END))
    plain = F.concat_ws(_END, *[F.coalesce(c, F.lit(_NULL)) for c in texts], F.lit(""))
    return F.when(_holds(F.concat_ws("", *texts), _NULL, _END, _MARK), escaped).otherwise(plain)


def _holds(text: Column, *signs: str) -> Column:
    found = [F.contains(text, F.lit(sign)) for sign in signs]
    return reduce(Column.__or__, found)


def unpack(packed: Column) -> Column:
    """The texts again, as an array with a blank one behind them; null if the packed row is null."""

    def plain(text: Column) -> Column:
        whole = text
        for sign, short in reversed(_ESCAPED):
            whole = F.replace(whole, F.lit(short), F.lit(sign))
        return F.when(text != _NULL, whole)

    texts = F.split(packed, _END)
    return F.when(_holds(packed, _NULL, _MARK), F.transform(texts, plain)).otherwise(texts)


def with_unpacked(df: DataFrame, packed: str, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """`df` with the columns of a packed one in its place, under their names behind `prefix`."""
    others = [F.col(f"`{c}`") for c in df.columns if c != packed]
    taken = df.select(*others, unpack(F.col(packed)).alias("_texts"))
    return taken.select(*others, *[F.get("_texts", F.lit(i)).alias(f"{prefix}{c}") for i, c in enumerate(columns)])
