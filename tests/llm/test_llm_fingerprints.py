import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF, edge_docs, edge_rows, texts

from snaptrack.llm import fingerprints as fp
from snaptrack.llm.queries import QUERIES


def slow_boundaries(data):
    ends, start = [0], 0
    hashes = [
        sum(int(fp.GEAR[data[i - j]]) << j for j in range(min(fp.REACH, i + 1))) & 0xFFFFFFFF for i in range(len(data))
    ]
    while start < len(data):
        end = start + fp.MOST
        for i in range(start + fp.LEAST - 1, min(len(data), start + fp.MOST)):
            mask = int(fp.STRICT if i - start + 1 < fp.NORMAL else fp.LOOSE)
            if hashes[i] & mask == 0:
                end = i + 1
                break
        start = min(end, len(data))
        ends.append(start)
    return ends


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.binary(max_size=700), st.binary(max_size=5).map(lambda x: x * 100)))
def test_boundaries_are_those_of_the_rolling_hash(data):
    assert fp.boundaries(data) == slow_boundaries(data)


def test_boundaries_move_with_the_content():
    text = max((t for _, t in texts()), key=len)
    own, shifted = fp.fingerprint(text), fp.fingerprint("some new words in front, " + text)
    assert fp.likeness(own, shifted) > 0.9 and fp.likeness(own, own) == 1
    assert fp.likeness(own, fp.fingerprint(text[: len(text) // 2])) > 0.9  # contained
    assert np.array_equal(fp.as_chunks(fp.as_text(own)), own)
    nothing = fp.fingerprint("")
    assert fp.likeness(nothing, nothing) == 1 and fp.likeness(own, nothing) == 0


def test_op1(spark):
    own = texts()[::-1]
    rows = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, SF).collect()}
    for k, (i, text) in enumerate(own):
        following = own[(k + 1) % len(own)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        r, chunks = rows[i], fp.fingerprint(text)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (fp.as_text(chunks), fp.as_text(fp.fingerprint(edited)))
        assert r.near_edited == fp.likeness(chunks, fp.fingerprint(edited))
        assert r.near_next == fp.likeness(chunks, fp.fingerprint(following))
    long = [r.near_edited for i, r in rows.items() if r.n_chars > 300]
    assert np.median(long) > 0.6


def test_edges(spark):
    docs = edge_docs(spark)
    found = fp.op1(docs).collect()
    assert len(found) == len(edge_rows())
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [r.near_next for r in by_id[3]].count(1.0) == 1 and len({r.fingerprint for r in by_id[3]}) == 1
    assert by_id[1][0].fingerprint == by_id[2][0].fingerprint == "" and by_id[2][0].near_next == 1
    assert by_id[None][0].n_chars == len("und der die das mit ein")
    assert fp.op1(docs.limit(0)).collect() == []
    one = docs.filter("doc_id = 9")
    assert fp.op1(one).first().near_next == 1
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        few = sorted(fp.op1(docs).collect(), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert few == sorted(found, key=str)
