"""Embedding near-dedup: an exact metric range join over pivots.

A cosine of at least `COSINE` between two vectors is a distance of at most R between the unit
vectors. Pivots are some of the vectors; each vector is at home in the cell of its nearest pivot.
A vector within R of another cell's vectors lies within R of the plane between the two pivots
(the triangle inequality in its tightest form), so it is sent to just those other cells, and of two
cells only to the one with the lower number: every pair meets exactly once. Cells are joined
independently, in blocks of at most `BLOCK` vectors against as many, so a cell that holds a third
of all vectors is split over many tasks. A task returns a count per vector and a spanning forest,
never its pairs. Equal vectors are one node from the start.

Cost: a cell's pairs are all compared, and vectors without any structure lie near most planes, so
on such data the join does not save comparisons; it only bounds each task.

Defined results: vectors that are null, empty or zero, that hold null or non-finite components, or
have a null id, link with nothing; vectors of different lengths neither; rows that repeat a vector
are vectors of their own; ids are taken as unique otherwise (rows of one id share their links); an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrack.llm.common import col, written
from snaptrack.llm.components import components, local_roots

COSINE = 0.95
#: Vectors at home in a cell on average, and pivots at most (their vectors are sent to every task).
CELL, MOST_PIVOTS = 2048, 4096
BLOCK, ROWS = 4096, 256
#: Added to squared distances between pivots, and to what is compared with them: far above the rounding
#: of products of unit vectors, so that no vector at a border is lost.
ROUNDING, SLACK = 1e-12, 1e-7


def unit(values: list[float | None] | None) -> np.ndarray | None:
    """The unit vector in double precision, or None for a vector that links with nothing."""
    if not values or any(x is None for x in values):
        return None
    v = np.array(values, np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if top == 0:
        return None
    v = v / top  # squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum())


def _units(vectors: pa.Array) -> list[bytes | None]:
    found = [unit(v) for v in vectors.to_pylist()]
    return [None if u is None else u.tobytes() for u in found]


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


class Cells:
    """Pivots by vector length, and which cells a vector belongs to."""

    def __init__(self, pivots: list[bytes], reach: float):
        self.reach = reach
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in {len(p) for p in pivots}:
            own = np.array([k for k, p in enumerate(pivots) if len(p) == size])
            m = _matrix([pivots[k] for k in own])
            # Never below the true distance: pivots may be equal but for rounding.
            gaps = np.sqrt(np.maximum(2 - 2 * m @ m.T, 0) + ROUNDING)
            self.by_size[size] = (own, m, gaps)

    def of(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in rows, cells, and whether the vector is at home there. Cells of lengths that no
        pivot has are negative."""
        places, cells, homes = [], [], []
        sizes = np.array([len(r) for r in rows])
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            if size not in self.by_size:
                places.append(at)
                cells.append(np.full(len(at), -size))
                homes.append(np.ones(len(at), bool))
                continue
            own, pivots, gaps = self.by_size[size]
            squares = 2 - 2 * (_matrix([rows[k] for k in at]) @ pivots.T)
            home = squares.argmin(1)
            every = np.arange(len(at))
            # The distance to the plane between the home pivot and each other one, times twice their
            # distance: between pivots that are nearly equal rounding picks the home, and all must meet.
            plane = squares - squares[every, home][:, None]
            sent = (plane <= 2 * self.reach * gaps[home] + SLACK) & (np.arange(len(own)) < home[:, None])
            sent[every, home] = True
            row, cell = np.nonzero(sent)
            places.append(at[row])
            cells.append(own[cell])
            homes.append(cell == home[row])
        return np.concatenate(places), np.concatenate(cells), np.concatenate(homes)


def _block(ids: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % blocks.astype(np.uint64)).astype(np.int64)


def join_blocks(
    a: np.ndarray, a_copies: np.ndarray, b: np.ndarray | None, b_copies: np.ndarray | None, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links of vectors a among themselves (b None) or with vectors b: how many each has, copies
    counted, and the least place each reaches (a first, then b)."""
    same = b is None
    if same:
        b, b_copies = a, a_copies
    n = len(a) + (0 if same else len(b))
    shift = 0 if same else len(a)
    counts, root = np.zeros(n, np.int64), np.arange(n)
    for low in range(0, len(a), ROWS):
        close = a[low : low + ROWS] @ b.T >= cosine
        if same:
            close[np.arange(len(close)), low + np.arange(len(close))] = False
        row, other = np.nonzero(close)
        if not len(row):
            continue
        counts[low : low + len(close)] += np.bincount(row, b_copies[other], len(close)).astype(np.int64)
        if not same:
            counts[shift:] += np.bincount(other, a_copies[low + row], len(b)).astype(np.int64)
        ends = np.stack([root[low + row], root[shift + other]], 1)
        ends = np.unique(ends[ends[:, 0] != ends[:, 1]], axis=0)
        if len(ends):
            root = local_roots(n, ends[:, 0], ends[:, 1])[root]
    return counts, root


def links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Rows (a, b, n) from distinct unit vectors (columns id, copies, unit): n links of vector a (b
    null), or a link a-b of a spanning forest (n null)."""
    n = vectors.count()
    k = min(MOST_PIVOTS, max(1, ceil(n / CELL)))
    pivots = [r["unit"] for r in vectors.orderBy(F.xxhash64("unit"), "id").limit(k).collect()]
    reach = sqrt(2 - 2 * cosine)
    cells = Cells([bytes(p) for p in pivots], reach)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, cell, home = cells.of(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(home)], ["cell", "home"])

    # One row a cell.
    sizes = vectors.select("unit").mapInArrow(count, "cell long, home boolean").groupBy("cell").agg(
        F.count_if("home").alias("home"), F.count_if(~F.col("home")).alias("visit")
    )
    blocks = {r["cell"]: (max(1, ceil(r["home"] / BLOCK)), ceil(r["visit"] / BLOCK)) for r in sizes.collect()}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, copies, units = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_pylist()
            place, cell, home = cells.of(units)
            own = np.array([blocks[c] for c in cell.tolist()]).reshape(-1, 2)
            block = _block(ids[place], np.maximum(np.where(home, own[:, 0], own[:, 1]), 1))
            rows = []
            for p, c, h, x, (homes, visits) in zip(place.tolist(), cell.tolist(), home.tolist(), block.tolist(), own.tolist(), strict=True):
                if h:
                    # Against home blocks (the lower one first), then against visitors (numbered from -1 down).
                    rows += [(p, c, min(x, y), max(x, y), 0 if x <= y else 1) for y in range(homes)]
                    rows += [(p, c, x, -1 - y, 0) for y in range(visits)]
                else:
                    rows += [(p, c, y, -1 - x, 1) for y in range(homes)]
            for low in range(0, len(rows), 2048):
                part = rows[low : low + 2048]
                at = [r[0] for r in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in part], pa.int64()) for j in (1, 2, 3, 4)]
                    + [pa.array(ids[at]), pa.array(copies[at]), pa.array([units[p] for p in at], pa.binary())],
                    ["cell", "one", "two", "side", "id", "copies", "unit"],
                )

    sent = vectors.select("id", "copies", "unit").mapInArrow(
        send, "cell long, one long, two long, side long, id long, copies long, unit binary"
    )

    def join(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        ids, copies = group.column("id").to_numpy(), group.column("copies").to_numpy()
        units = group.column("unit").to_pylist()
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = group.column("one")[0].as_py() == group.column("two")[0].as_py()
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        if not len(first) or not (alone or len(second)):
            return empty
        order = first if alone else np.concatenate([first, second])
        b, b_copies = (None, None) if alone else (_matrix([units[k] for k in second]), copies[second])
        counts, root = join_blocks(_matrix([units[k] for k in first]), copies[first], b, b_copies, cosine)
        own, linked = ids[order], np.flatnonzero(root != np.arange(len(root)))
        some = np.flatnonzero(counts)
        nothing = np.zeros(len(some) + len(linked), bool)
        nothing[: len(some)] = True
        return pa.table({
            "a": pa.array(np.concatenate([own[some], own[linked]])),
            "b": pa.array(np.concatenate([own[some], own[root[linked]]]), mask=nothing),
            "n": pa.array(np.concatenate([counts[some], np.zeros(len(linked), np.int64)]), mask=~nothing),
        })

    return sent.groupBy("cell", "one", "two").applyInArrow(join, "a long, b long, n long")


def near_copies(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per vector: id, n_links, component (the smallest id its links reach)."""

    @F.arrow_udf("unit binary, key binary")
    def units(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in batches:
            found = _units(v)
            keys = [None if u is None else hashlib.blake2b(u, digest_size=16).digest() for u in found]
            yield pa.StructArray.from_arrays([pa.array(found, pa.binary()), pa.array(keys, pa.binary())], ["unit", "key"])

    narrow = vectors.select(col(id_col).alias("id"), units(col(vector_col).cast("array<double>")).alias("u"))
    keyed = written(
        narrow.select("id", "u.unit", F.when(F.col("id").isNotNull(), F.col("u.key")).alias("key")), "vectors"
    )
    nodes = written(
        keyed.filter("key IS NOT NULL").groupBy("key").agg(
            F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("unit").alias("unit")
        ),
        "vector-nodes",
    )
    found = written(links(nodes.select(F.col("first").alias("id"), "copies", "unit"), cosine), "vector-links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("counted")).agg(F.sum("n").alias("n"))
    linked = components(found.filter("b IS NOT NULL").select("a", "b"))
    per_node = (
        nodes.select(F.col("key").alias("node_key"), "first", "copies")
        .join(counts, F.col("first") == F.col("counted"), "left")
        .join(linked, F.col("first") == F.col("node"), "left")
        .select(
            "node_key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "first").alias("component"),
        )
    )
    return keyed.select("id", "key").join(per_node, F.col("key") == F.col("node_key"), "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component")
    )


def op2(vectors: DataFrame) -> DataFrame:
    found = near_copies(vectors.select("vec_id", "embedding"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )
