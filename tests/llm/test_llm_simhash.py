import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF, edge_docs, edge_rows, texts
from pyspark.sql import functions as F

from snaptrack.llm import simhash
from snaptrack.llm.components import components, local_roots
from snaptrack.llm.queries import QUERIES


def slow_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(words):
    near = np.bitwise_count(words[:, None] ^ words[None, :]) <= 3
    return local_roots(len(words), *np.nonzero(np.triu(near, 1)))


def test_fingerprints():
    odd = ["", None, "A", "a b", "Ärger ÄRGER x\x0by\x1cz", "É é  É", *(t for _, t in texts()[:40])]
    assert [simhash.simhash(t) for t in odd] == [slow_simhash(t) for t in odd]


def near_words(seed, n=60):
    rnd = np.random.default_rng(seed)
    base = rnd.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rnd.integers(0, 2, n, dtype=np.uint64)
    found = [base]
    for bits in (1, 2, 3, 4):
        for _ in range(3):
            flipped = base.copy()
            for i in range(n):
                for b in rnd.choice(64, bits, replace=False):
                    flipped[i] ^= np.uint64(1 << int(b))
            found.append(flipped)
    return np.unique(np.concatenate(found))


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 1 << 30), st.lists(st.integers(0, 63), min_size=1, max_size=6, unique=True))
def test_cells_find_what_comparing_all_finds(seed, bits):
    words, ends = near_words(seed, 12), []
    for cell in range(1 << len(bits)):
        ends.append(simhash.cell_links(words, cell, bits))
    pairs = np.concatenate(ends)
    assert np.array_equal(local_roots(len(words), pairs[:, 0], pairs[:, 1]), roots(words))
    assert (np.bitwise_count(words[pairs[:, 0]] ^ words[pairs[:, 1]]) <= 3).all()


def test_links_over_cells(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 32)
    words = near_words(5)
    signed = words.view(np.int64).tolist()
    linked = components(simhash.links(spark.createDataFrame([(w,) for w in signed], "fp long")))
    found = {r.node: r.component for r in linked.collect()}
    label = [found.get(w, w) for w in signed]
    want = roots(words).tolist()
    assert [label.index(x) for x in label] == [want.index(x) for x in want]


def test_components_of_any_links(spark):
    rnd = np.random.default_rng(9)
    a, b = rnd.integers(0, 400, 330), rnd.integers(0, 400, 330)
    a, b = np.append(a, [7] * 60 + list(range(500, 560))), np.append(b, list(range(430, 490)) + list(range(501, 561)))
    root = local_roots(600, a, b)
    found = {r.node: r.component for r in components(spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long")).collect()}
    assert all(found.get(i, i) == root[i] for i in range(600))
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_op6(spark):
    own = texts()
    words = np.array([slow_simhash(t) for _, t in own], np.uint64)
    ids = [i for i, _ in own]
    want = {i: (f"{w:016x}", ids[r]) for i, w, r in zip(ids, words.tolist(), roots(words), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op6_simhash"](spark, SF).collect()} == want


def test_edges(spark):
    docs = edge_docs(spark)
    found = simhash.op6(docs).collect()
    assert len(found) == len(edge_rows())
    by_id = {r.doc_id: r for r in found}
    assert {by_id[k].component_id for k in (1, 2, 4)} == {1} and by_id[1].fingerprint == "0" * 16
    assert by_id[6].component_id == by_id[7].component_id == 6
    assert by_id[None].component_id is None
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, 5, 6, 8, 9, None]
    assert simhash.op6(docs.limit(0)).collect() == [] and simhash.keep_one(docs.limit(0)).collect() == []
    same = docs.filter("doc_id = 3").select("doc_id", "text")
    assert simhash.keep_one(same.union(same.select(F.lit(None).cast("long"), "text"))).collect() == same.limit(1).collect()


def test_of_rows_equal_in_id_and_text_the_same_one_stays(spark):
    rows = [(1, "a b c d e", s, "k") for s in ("x", "y", "z", None)] * 2
    kept = set()
    for parts in (1, 3, 7):
        docs = spark.createDataFrame(rows[parts:] + rows[:parts], "doc_id long, text string, source string, `a.b` string")
        (row,) = simhash.keep_one(docs.repartition(parts)).collect()
        kept.add(tuple(row))
    assert len(kept) == 1
