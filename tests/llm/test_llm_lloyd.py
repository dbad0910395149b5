import hashlib
import math

import numpy as np
import pytest
from compare import compare, connect
from llm_cases import SF

from snaptrack.llm import lloyd

SCHEMA = "vec_id long, embedding array<float>"


def slow(rows, dimensions=64, scale=64, clusters=16, rounds=3, seed=1):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:clusters]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for k, own in members.items():
            centroids[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(d for _, _, d in found)
    of = {k: sum(d for _, c, d in found if c == k) for k in range(len(centroids))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, of[k], total, digests[k]) for i, k, d in found), key=repr)


def random_rows(seed, n, size):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 1, (5, size))
    found = centres[rnd.integers(0, 5, n)] + rnd.normal(0, 0.3, (n, size))
    found[: n // 3] = found[0]  # a hot vector
    return [(k, v.astype(np.float32).tolist()) for k, v in enumerate(found)]


@pytest.mark.parametrize(("chunk", "columns"), [(2048, 16), (7, 16), (50, 64), (50, 5)])
def test_rows_are_those_of_plain_loops(spark, monkeypatch, chunk, columns):
    monkeypatch.setattr(lloyd, "CHUNK", chunk)
    monkeypatch.setattr(lloyd, "COLUMNS", columns)
    rows = random_rows(chunk, 150, 64)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found, centroids = lloyd.cluster(docs, columns=columns)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == [r[:3] for r in slow(rows)]
    assert len(centroids) == 16


def test_other_sizes(spark):
    rows = random_rows(3, 90, 7)
    found, _ = lloyd.cluster(spark.createDataFrame(rows, SCHEMA), dimensions=7, scale=1000, clusters=4, rounds=6, seed=9, columns=3)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == [r[:3] for r in slow(rows, 7, 1000, 4, 6, 9)]
    with pytest.raises(ValueError, match="too large"):
        lloyd.cluster(spark.createDataFrame(rows, SCHEMA), clusters=1 << 20)


def test_query_matches_its_sql(spark):
    run = lambda s, sf: lloyd.op13(s.read.parquet(f"{sf}/embeddings.parquet"))
    rows, problems = compare(spark, connect(SF), run, lloyd.ORACLE, SF)
    assert rows and not problems


def test_a_shard_holds_its_own_columns_only(spark):
    rows = random_rows(5, 20, 64)
    table = lloyd.blocks(lloyd.integers(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", 64, 64), 16, 2048)
    parts = lloyd.partial_distances(table, 2, np.zeros((4, 16), np.int64))
    assert "PartitionFilters: [isnotnull(shard" in parts._jdf.queryExecution().toString()
    own = {r.chunk: np.frombuffer(r.part, "<i8").reshape(-1, 4) for r in parts.collect()}
    want = sorted(sum(math.floor(64 * x) ** 2 for x in v[32:48]) for _, v in rows)
    assert sorted(np.concatenate(list(own.values()))[:, 0].tolist()) == want


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    one = [k / 64 for k in range(64)]
    rows = [
        (1, one), (2, None), (3, one[:63]), (4, [*one, 1.0]), (5, [None, *one[1:]]), (6, [nan, *one[1:]]), (7, [-inf, *one[1:]]),
        (8, []), (None, [-x for x in one]), (9, one), (9, [x + 0.3 for x in one]), (None, one), (10, [0.0] * 64), (11, [-0.001] * 64),
    ]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], SCHEMA + ", cluster int, id string")
    assert sorted((tuple(r) for r in lloyd.op13(df).collect()), key=repr) == slow(rows)
    assert lloyd.op13(df.limit(0)).collect() == [] and lloyd.op13(df.filter("vec_id = 2")).collect() == []
    far = spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64), (3, one)], SCHEMA)
    found = {r.vec_id: r for r in lloyd.op13(far).collect()}
    assert [found[k].distance for k in (1, 2, 3)] == [0, 0, 0] and len({r.cluster for r in found.values()}) == 3
