import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF, edge_docs, edge_rows, texts
from tokenizers import Tokenizer

from snaptrack.llm import packing
from snaptrack.llm.bpe import BYTE_VOCABULARY, vocabulary_path
from snaptrack.llm.queries import QUERIES


def test_bits():
    assert [packing.bits_for(n) for n in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 32), st.integers(0, 400), st.integers(0, 1 << 32), st.data())
def test_any_stretch_unpacks(bits, n, seed, data):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, n).astype("<u4")
    packed = packing.pack(ids, bits)
    assert len(packed) == (n * bits + 7) // 8
    first = data.draw(st.integers(0, n))
    count = data.draw(st.integers(0, n - first))
    assert np.array_equal(packing.unpack(packed, bits, first, count), ids[first : first + count])


@pytest.mark.parametrize("file_ids", [1, 40_000, 1 << 30])
def test_files_give_random_access(monkeypatch, file_ids):
    monkeypatch.setattr(packing, "FILE_IDS", file_ids)
    monkeypatch.setattr(packing, "BLOCK_IDS", 1000)
    rnd = np.random.default_rng(3)
    docs = [rnd.integers(0, 50_257, n).astype("<u4") for n in (1, 999, 1000, 1001, 5, 40_000, 1, 3)]
    builder, files = packing.FileBuilder(7, 16), {}
    rows = [r for k, ids in enumerate(docs) for r in builder.add(None if k == 4 else 10 * k, ids)]
    for name, data in [*rows, *builder.close()]:
        files.setdefault(name, []).append(data + b"\n")
    opened = [packing.TokenFile(b"".join(files[k])) for k in sorted(files)]
    found = [(int(f.doc_ids[k]), f.document(k)) for f in opened for k in range(len(f.doc_ids))]
    assert [i for i, _ in found] == [0, 10, 20, 30, packing.NO_ID, 50, 60, 70]
    assert all(np.array_equal(a, b) for (_, a), b in zip(found, docs, strict=True))
    assert len(opened) == {1: 8, 40_000: 2, 1 << 30: 1}[file_ids]
    with pytest.raises(ValueError):
        packing.TokenFile(b"x" * 100)


def test_op5_is_the_librarys(spark):
    library, start = Tokenizer.from_file(vocabulary_path(BYTE_VOCABULARY)), 0
    rows = {r.doc_id: r for r in QUERIES["op5_token_files"](spark, SF).collect()}
    for i, text in texts():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_files_are_whole_when_the_sort_before_the_write_spills(spark, tmp_path):
    """Spark sorts by file alone before it writes, and merges spilled runs without order among ties."""
    key, conf = "spark.shuffle.spill.numElementsForceSpillThreshold", spark._jvm.org.apache.spark.SparkEnv.get().conf()
    rows = [(k, f" {chr(97 + k % 26)}" * (9_000 + 17 * k)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    conf.set(key, "2")
    try:
        packing.write_ids(docs, str(tmp_path / "out"))
    finally:
        conf.remove(key)
    library = Tokenizer.from_file(vocabulary_path(BYTE_VOCABULARY))
    found = {r.doc_id: r.ids for r in packing.read_ids(spark, str(tmp_path / "out")).collect()}
    for i, text in rows:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert np.array_equal(np.frombuffer(found[i], "<u4"), ids)


def test_edges(spark):
    found = packing.op5(edge_docs(spark)).collect()
    assert len(found) == len(edge_rows())
    by_id = {r.doc_id: r for r in found}
    assert by_id[None].start == 0 and by_id[1].n_tokens == by_id[2].n_tokens == 1
    assert sum(r.n_tokens for r in found) == max(r.start + r.n_tokens for r in found)
    assert packing.op5(edge_docs(spark).limit(0)).collect() == []
    special = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id long, text string")
    assert packing.op5(special).first().n_tokens == 4


@pytest.mark.parametrize("hashes", ["own", "few"])
def test_pieces_are_found_by_their_bytes(monkeypatch, hashes):
    """Whatever the hashes and however often the table begins anew, ids are those of the piece."""
    from snaptrack.llm import piecetable

    if hashes == "few":
        real = piecetable.string_hashes
        monkeypatch.setattr(piecetable, "string_hashes", lambda d, o: real(d, o) % np.uint64(5))
    encode = lambda pieces: [np.array([ord(c) for c in p], "<u4").tobytes() for p in pieces]
    rnd = np.random.default_rng(1)
    for most in (1, 30, 10_000):
        table = piecetable.PieceTable(encode, most)
        for _ in range(12):
            texts = ["".join(rnd.choice(list("ab é日"), rnd.integers(0, 60))) for _ in range(15)] + ["", "x" * 3000]
            found = table.encode_texts(texts, False)
            assert ["".join(map(chr, ids)) for ids in found] == texts
    assert table.encode_texts([], False) == []
