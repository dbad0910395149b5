import duckdb
import numpy as np
import pytest

from snaptrack.llm import vectors
from snaptrack.llm.components import local_roots


def slow(rows):
    units = np.array([vectors.unit(v) for _, v in rows])
    near = units @ units.T >= 0.95
    np.fill_diagonal(near, False)
    root = local_roots(len(rows), *np.nonzero(np.triu(near)))
    return {i: (int(near[k].sum()), rows[root[k]][0]) for k, (i, _) in enumerate(rows)}


def clustered(seed, n, size=16):
    """Random vectors, a third of them close to one, some repeated and some only scaled."""
    rnd = np.random.default_rng(seed)
    found = rnd.normal(0, 1, (n, size))
    found[: n // 3] = found[0] + rnd.normal(0, 0.06, (n // 3, size)) * rnd.uniform(0, 3, (n // 3, 1))
    found[n // 2 : n // 2 + 10] = found[n // 2]
    found[n // 2 + 10 : n // 2 + 14] = found[n // 2] * 3.5
    return [(k, v.tolist()) for k, v in enumerate(found)]


@pytest.mark.parametrize(("cell", "block"), [(10_000, 4096), (40, 4096), (40, 7), (500, 50)])
def test_all_links_are_found_whatever_the_cells(spark, monkeypatch, cell, block):
    monkeypatch.setattr(vectors, "CELL", cell)
    rows, unchanged = clustered(cell + block, 300), vectors.BLOCK
    real = vectors._block
    monkeypatch.setattr(vectors, "BLOCK", block)
    assert real is vectors._block and unchanged
    found = vectors.op2(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == slow(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


@pytest.mark.parametrize("noise", [0, 1e-12, 1e-9, 1e-8, 1e-6])
def test_pivots_that_are_nearly_equal_lose_no_link(spark, monkeypatch, noise):
    """Hundreds of scaled copies of one vector, unequal by rounding or noise only, over many pivots."""
    monkeypatch.setattr(vectors, "CELL", 10)
    rnd = np.random.default_rng(5)
    one = rnd.normal(0, 1, 48)
    found = np.concatenate([
        (one + noise * rnd.normal(0, 1, (400, 48))) * rnd.uniform(0.1, 9, (400, 1)), rnd.normal(0, 1, (200, 48)),
    ])
    # Near the edge of the reach of the copies: some of these link with all of them, others with none.
    found[400:500] = one + found[400:500] * rnd.uniform(0.2, 0.45, (100, 1))
    rows = [(k, v.tolist()) for k, v in enumerate(found)]
    assert len({vectors.unit(v).tobytes() for _, v in rows}) > 300 or not noise
    got = vectors.op2(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == slow(rows)


def test_given_vectors(spark):
    sf = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"select vec_id, embedding from '{sf}/embeddings.parquet' order by 1").fetchall()
    found = vectors.op2(spark.read.parquet(f"{sf}/embeddings.parquet")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == slow(rows)


def test_cells_send_a_pair_to_one_cell_only():
    rows = [vectors.unit(v).tobytes() for _, v in clustered(3, 200)]
    cells = vectors.Cells(rows[:20], 0.316)
    place, cell, home = cells.of(rows)
    assert sorted(place[home].tolist()) == list(range(200))
    own = dict(zip(place[home].tolist(), cell[home].tolist(), strict=True))
    assert all(c < own[p] for p, c, h in zip(place.tolist(), cell.tolist(), home.tolist(), strict=True) if not h)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 9), (2, [2.0, 0.0], 9), (3, None, 9), (4, [0.0, 0.0], 9), (5, [1.0, None], 9), (6, [nan, 1.0], 9),
        (7, [1.0, 0.0, 0.0], 9), (None, [1.0, 0.0], 9), (9, [1.0, 0.05], 9), (10, [], 9), (11, [1.0, 0.0], 9),
        (12, [inf, 0.0], 9), (13, [1e-300, 0.0], 9), (14, [1e300, 1e300], 9), (15, [-1.0, 0.0], 9),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.op2(df).collect()}
    assert len(found) == len(rows)
    assert [found[i] for i in (1, 2, 9, 11, 13)] == [(4, 1, True)] + [(4, 1, False)] * 4
    assert all(found[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 10, 12, 14, 15))
    assert found[None] == (0, None, None)
    assert vectors.op2(df.limit(0)).collect() == []
