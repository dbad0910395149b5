"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb


def connect(sf: str):
    con = duckdb.connect()
    for f in sorted(Path(sf).glob("*.parquet")):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_cell(r[i]) for i in order) for r in rows
    )


SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE",
}


def compare(spark, con, run, sql: str, sf: str):
    df = run(spark, sf)
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    names, types = list(relation.columns), [str(x) for x in relation.types]
    want_names, want = _rows(names, relation.fetchall())
    problems = []
    if got_names != want_names:
        problems.append(f"columns {got_names} != {want_names}")
    kinds = {n: SPARK_TO_DUCK.get(k, k) for n, k in df.dtypes}
    for n, k in zip(names, types, strict=True):
        if kinds.get(n) != k:
            problems.append(f"type of {n}: {kinds.get(n)} != {k}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        problems.append(f"spark only {only_got} / sql only {only_want}")
    return len(got), problems
