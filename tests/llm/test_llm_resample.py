import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, connect
from llm_cases import LONG, SF, edge_docs

from snaptrack.llm import resample
from snaptrack.llm.words import GROUP, PATTERN, Words, groups


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return re.findall(PATTERN, lowered(text))


def features_of(text, longest):
    words = words_of(text)
    return [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def slow(docs, target, longest=1, buckets=10_000, seed=2024, percent=10, least=20):
    """Rows (id, n_features, weight, score, rank), in plain loops."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features_of(t, longest))
    t = Counter(bucket(f) for x in target for f in features_of(x, longest))
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        own = [bucket(f) for f in features_of(text, longest)]
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in own]
        weight = sum(gains) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(own), weight, score, None, len(words_of(text))])
    order = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, -r[1]))
    for k, r in enumerate(order[: percent * len(order) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def texts(n=120):
    rnd = np.random.default_rng(4)
    vocabulary = [f"w{k}" for k in range(80)] + ["Äpfel", "ÜBER", "日本語の文章", "x" * 200, "y" * 64, "z" * 65]
    rows = [(k, " ".join(rnd.choice(vocabulary, rnd.integers(0, 60))) + ".") for k in range(n)]
    return rows + [(None, rows[3][1]), (7, rows[7][1]), (7, "Other words " * 15)], [rows[5][1], "w1 w2 w3 " * 9, None, ""]


def test_checksums_are_those_of_zlib():
    rnd = np.random.default_rng(1)
    for size in (1, 2, 63, 64, 65, 128, 129, 5000, 70_001):
        strings = [rnd.integers(0, 256, n, np.uint8).tobytes() for n in (size, size, 1, 3, size + 64)]
        offsets = np.append(0, np.cumsum([len(x) for x in strings]))
        found = resample.crc32s(np.frombuffer(b"".join(strings), np.uint8), offsets)
        assert found.tolist() == [zlib.crc32(x) for x in strings]
    assert resample.crc32s(np.empty(0, np.uint8), np.zeros(1, np.int64)).tolist() == []


def test_words_are_those_of_the_pattern():
    rows = ["Ab-cd", "ef", "", None, "x", "Ünï·¿ 12,34ÀÖ\x00\x7fend", " ", "İ" * 3, "a" * 9]
    words = Words(pa.array(rows))
    found = [words.data[a:b].tobytes().decode() for a, b in zip(words.offsets, words.offsets[1:])]
    assert [found[a:b] for a, b in zip(words.firsts, words.firsts[1:])] == [words_of(x) for x in rows]
    sliced = Words(pa.array(["zz", *rows]).slice(1))
    assert sliced.firsts.tolist() == words.firsts.tolist() and sliced.data.tobytes() == words.data.tobytes()
    hashes = words.hashes()
    assert len(set(hashes.tolist())) == len(set(found))
    assert sum(len(t) for _, t in groups(pa.array(["x" * (GROUP // 2)] * 5 + [None, "y"]))) == 7
    assert [len(t) for _, t in groups(pa.array(["x" * (GROUP // 2)] * 3))] == [2, 1]
    assert list(groups(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 50, "percent": 33, "least_words": 5}, {"buckets": 1, "percent": 100}])
def test_rows_are_those_of_plain_loops(spark, options):
    docs, target = texts()
    found = resample.resample(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame([(t,) for t in target], "text string"), keep=["doc_id"], **options,
    ).select("doc_id", "resampled.*").collect()
    plain = {{"least_words": "least"}.get(k, k): v for k, v in options.items()}
    assert sorted((tuple(r) for r in found), key=repr) == slow(docs, target, **plain)


def test_query_matches_its_sql(spark):
    run = lambda s, sf: resample.op12(s.read.parquet(f"{sf}/documents.parquet"), s.read.parquet(f"{sf}/benchmark.parquet"))
    rows, problems = compare(spark, connect(SF), run, resample.ORACLE, SF)
    assert rows and not problems


def test_the_draw_prefers_what_is_like_the_target(spark):
    """Half the documents use the target's words: they are drawn far more often."""
    rnd = np.random.default_rng(2)
    rows = [(k, " ".join(rnd.choice([f"{'t' if k % 2 else 'o'}{j}" for j in range(30)], 40)), f"s{k}") for k in range(600)]
    target = spark.createDataFrame([(" ".join(f"t{j}" for j in range(30)),)] * 200, "text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")
    drawn = resample.draw(docs, target).collect()
    assert len(drawn) == 60 and drawn[0].asDict().keys() == {"doc_id", "text", "a.b"}
    assert sum(r.doc_id % 2 for r in drawn) > 55
    assert {(r[0], r[1], r[2]) for r in drawn} <= set(rows)


def test_edges(spark):
    docs, target = edge_docs(spark), spark.createDataFrame([(None,), ("",)], "text string")
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    found = resample.op12(docs, target).collect()
    assert sorted((tuple(r) for r in found), key=repr) == slow(plain, [None, ""])
    assert any(r.n_features == len(LONG.split()) for r in found)
    named = resample.resample(docs.withColumn("resampled", docs["n_chars"]), target, percent=100)
    assert named.columns[-1] == "resampled_" and named.count() == len(plain)
    assert resample.op12(docs.limit(0), target.limit(0)).collect() == []
