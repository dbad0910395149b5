import hashlib
import re

import numpy as np
import pytest
from compare import compare, connect
from llm_cases import LONG, SF, edge_docs

from snaptrack.llm import decontaminate
from snaptrack.llm.words import PATTERN

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words_of(text):
    return re.findall(PATTERN, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items, window=10):
    windows = set()
    for i, text in items:
        words = words_of(text)
        size = min(window, len(words))
        windows |= {("" if i is None else str(i), tuple(words[k : k + size])) for k in range(len(words) - size + 1) if size}
    sizes, rows = {len(own) for _, own in windows}, []
    of = {}
    for item, own in windows:
        of.setdefault(own, set()).add(item)
    for i, text in docs:
        words, hit, held = words_of(text), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if items_here := of.get(tuple(words[k : k + size])):
                    hit |= set(range(k, k + size))
                    held |= items_here
        digest = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        rows.append((i, len(words), len(hit), len(held), digest, bool(hit)))
    return sorted(rows, key=repr)


def fast(spark, docs, items):
    found = decontaminate.op11(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS))
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_rows_are_those_of_plain_loops(spark, seed):
    """A small vocabulary, so that windows overlap, repeat and nearly match; items of all lengths."""
    rnd = np.random.default_rng(seed)
    vocabulary = ["A", "b", "Cé", "d1"][: 2 + seed]
    sentence = lambda low, high: " ".join(rnd.choice(vocabulary, rnd.integers(low, high)))
    docs = [(k, sentence(0, 90)) for k in range(40)]
    items = [(k, sentence(8, 25)) for k in range(6)] + [(9, docs[3][1].replace(" ", ", ")), (9, sentence(5, 6))]
    if seed == 2:
        items += [(20, "d1 A d1"), (21, "Cé d1"), (None, "b, b, b b"), (22, "unseen"), (23, " -- ")]
    assert fast(spark, docs, items) == slow(docs, items)


def test_windows_are_joined_without_broadcast_too(spark):
    docs = [(k, "common words of a passage that many documents share by copying it " + f"own{k} " * (k % 7)) for k in range(300)]
    items = [(1, docs[0][1]), (2, "a passage that many documents share by copying it own5 own5 own5")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert fast(spark, docs, items) == slow(docs, items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_BITS", 1 << 15)
    monkeypatch.setattr(decontaminate, "BITS_EACH", 1 << 10)
    rnd = np.random.default_rng(8)
    vocabulary = [f"v{k}" for k in range(3000)]
    docs = [(k, " ".join(rnd.choice(vocabulary, 400))) for k in range(30)]
    items = [(k, " ".join(rnd.choice(vocabulary, 3000))) for k in range(15)] + [(90, " ".join(docs[4][1].split()[50:61]))]
    found = fast(spark, docs, items)
    assert found == slow(docs, items) and sum(r[2] for r in found) == 11


def test_query_matches_its_sql(spark):
    run = lambda s, sf: decontaminate.op11(s.read.parquet(f"{sf}/documents.parquet"), s.read.parquet(f"{sf}/benchmark.parquet"))
    rows, problems = compare(spark, connect(SF), run, decontaminate.ORACLE, SF)
    assert rows and not problems


def test_clean_keeps_whole_documents(spark):
    docs = spark.createDataFrame([(1, "one two three four", 5), (2, "two three", 6), (None, "two three", 7), (None, "x", 8), (4, None, 9)], "doc_id long, text string, hit_id int")
    items = spark.createDataFrame([(1, "Two -three")], ITEMS)
    assert [tuple(r) for r in decontaminate.clean(docs.withColumnRenamed("hit_id", "extra"), items).collect()] == [(4, None, 9)]


def test_edges(spark):
    docs = edge_docs(spark)
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, None), (2, ""), (3, " ... "), (4, " ".join(LONG.split()[500:515])), (4, "with that was her"), (None, "ONE"), (6, "12345")]
    own = spark.createDataFrame([(*i, 1, "p") for i in items], ITEMS + ", place int, window string")
    found = sorted((tuple(r) for r in decontaminate.op11(docs, own).collect()), key=repr)
    assert found == slow(plain, items)
    none = decontaminate.op11(docs, own.limit(0)).collect()
    assert len(none) == len(plain) and not any(r.contaminated for r in none)
    assert decontaminate.op11(docs.limit(0), own).collect() == []
