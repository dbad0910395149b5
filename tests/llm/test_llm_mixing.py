import pytest
from compare import compare, connect
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF, edge_docs, edge_rows
from pyspark.sql import functions as F

from snaptrack.llm import mixing
from snaptrack.llm.queries import ORACLES, QUERIES


def test_rows_are_those_of_the_sql(spark):
    assert compare(spark, connect(SF), QUERIES["op9_mix"], ORACLES["op9_mix"], SF) == (200, [])


def slow_targets(sizes):
    """The contract word by word: reshare what stops at the cap until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 20, "c": 30, None: 7}, {"a": 1000, "b": 1, "c": 1, "d": 500, "e": 3}, {"x": 5}, {"a": 0, "b": 9}, {None: 4, "z": 0},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert found == pytest.approx(slow_targets(sizes))


def slow_quotas(votes, seats):
    quota = [0] * len(votes)
    for _ in range(seats):
        k = max(range(len(votes)), key=lambda k: (votes[k] / (2 * quota[k] + 1), -k))
        quota[k] += 1
    return quota


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(1, 5000), min_size=1, max_size=9), st.integers(0, 120))
def test_highest_quotients(spark, votes, seats):
    cells = spark.createDataFrame([(0, k, v, seats) for k, v in enumerate(votes)], "g int, cell int, v long, s long")
    found = {r.cell: r.quota for r in mixing.highest_quotients(cells, ["g"], "v", "s", "cell").collect()}
    assert [found[k] for k in range(len(votes))] == slow_quotas(votes, seats)


def test_every_source_comes_near_its_target_in_any_sharding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "text")
    for shard_words in (1 << 20, 3000):
        mixed = mixing.mix(docs, shard_words=shard_words).select("source", "mix.*")
        sums = mixed.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("w"), F.count_if(F.expr("taken > 2 * size or taken < 0")).alias("bad"))
        shards = 1 + 400_000 // shard_words
        assert all(r.bad == 0 and abs(r.t - r.w) <= mixing.BLOCK_WORDS * (2 + shards) for r in sums.collect())


def test_the_texts_hold_the_words_taken(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("keep", F.lit(1))
    mixed = mixing.apply(docs)
    assert mixed.columns == docs.columns
    n = mixing.words(F.col("text"))
    got = {r.doc_id: (r.n, r.c) for r in mixed.groupBy("doc_id").agg(F.sum(n).alias("n"), F.sum("n_chars").alias("c")).collect()}
    plan = {r.doc_id: r.taken for r in mixing.op9(docs).collect() if r.taken}
    assert {k: v[0] for k, v in got.items()} == plan
    whole = {r.text for r in docs.select("text").collect()}
    parts = [r for r in mixed.collect() if r.text not in whole]
    assert all(r.n_chars == len(r.text) for r in parts)


def test_edges(spark):
    docs = edge_docs(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "mix_"]
    rows = mixing.op9(docs).collect()
    assert len(rows) == len(edge_rows()) and sorted(map(str, rows)) == sorted(map(str, mixing.op9(docs).collect()))
    assert all(r.taken <= 2 * r["size"] for r in rows) and all(r["size"] == 0 for r in rows if r.doc_id in (1, 2, 4))
    nulls = {r.source_size for r in rows if r.doc_id in (3, 9)}
    assert nulls == {15}
    assert mixing.op9(docs.limit(0)).collect() == [] and mixing.apply(docs.limit(0)).collect() == []
    silent = docs.filter("doc_id in (1, 2)")
    assert [r.taken for r in mixing.op9(silent).collect()] == [0, 0] and mixing.apply(silent).collect() == []
