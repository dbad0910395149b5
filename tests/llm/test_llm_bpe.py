import hashlib
import random

import numpy as np
import pytest
from llm_cases import SF, edge_docs, edge_rows, texts
from tokenizers import Tokenizer

from snaptrack.llm import bpe
from snaptrack.llm.characters import assignable, text_of
from snaptrack.llm.pretokens import Ids, Pieces, encode_texts
from snaptrack.llm.queries import QUERIES

SIGNS = "abAB ' \t\n\x1c\x1f　 éÉßΣσςİıǅ中文1२½Ⅷ²!?.,<|>/w🙂👍🏽ﬁ'sT'LL'd\x85​́­_-&;"


def fuzz(n=2500, seed=1):
    rnd = random.Random(seed)
    found = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 50))) for _ in range(n)]
    found += ["".join(rnd.choice("abehtrs") for _ in range(rnd.randint(1, 80))) for _ in range(300)]
    return [*found, "<|endoftext|>a<|startoftext|> b<|endoftext|>", "a" * 70, "ab" * 40, " " * 50, "the" * 40, "", "x <|endof"]


@pytest.mark.parametrize("name", [bpe.WORD_VOCABULARY, bpe.BYTE_VOCABULARY])
def test_ids_and_texts_are_the_librarys(name):
    path = bpe.vocabulary_path(name)
    library, mine, back = Tokenizer.from_file(path), bpe.encoder(path), bpe.decoder(path)
    some = [*fuzz(), *(t for _, t in texts())]
    for text, ids in zip(some, mine.encode(some), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert back.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("name", [bpe.WORD_VOCABULARY, bpe.BYTE_VOCABULARY])
@pytest.mark.parametrize("around", ["a{}b", "'s{}", "x {}1{}", "a\u0345{}\u0323 {}\u0301"])
def test_every_code_point_is_encoded_as_the_library_does(name, around):
    library, mine = Tokenizer.from_file(bpe.vocabulary_path(name)), bpe.encoder(bpe.vocabulary_path(name))
    some = [around.replace("{}", c) for c in text_of(assignable())]
    wanted = library.encode_batch_fast(some, add_special_tokens=False)
    for text, ids, want in zip(some, mine.encode(some), wanted, strict=True):
        assert ids.tolist() == want.ids, ascii(text)


def test_letters_of_other_versions_of_unicode():
    path = bpe.vocabulary_path(bpe.WORD_VOCABULARY)
    library = Tokenizer.from_file(path)
    some = ["a\u1c89b", "\U00011935\U00011930 A", "A\u0898\u0323\u0301", "\ua7cb \ua7da", "ΑΣ ΣΑ\u1c89Σ"]
    assert [x.tolist() for x in bpe.encoder(path).encode(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_neighbours_fit_as_merging_by_rank_leaves_them():
    merges = [("a", "b"), ("c", "d"), ("ab", "c"), ("b", "c"), ("a", "a"), ("aa", "a")]
    ids = {t: i for i, t in enumerate(["a", "b", "c", "d", *("".join(m) for m in merges)])}
    table = bpe.Merges(ids, merges)

    def merged(tokens):
        while True:
            ranked = [(merges.index(p), k) for k, p in enumerate(zip(tokens, tokens[1:])) if p in merges]
            if not ranked:
                return tokens
            k = min(ranked)[1]
            tokens = [*tokens[:k], tokens[k] + tokens[k + 1], *tokens[k + 2 :]]

    for left in ids:
        for right in ids:
            assert table.fits(ids[left], ids[right]) == (merged([*left, *right]) == [left, right]), (left, right)


def test_forgetting_changes_nothing():
    path = bpe.vocabulary_path(bpe.BYTE_VOCABULARY)
    some = [t for _, t in texts()][:40]
    small = Ids(bpe.encoder(path).encode_pieces, False, 8)
    want = bpe.encoder(path).encode(some)
    for k, ids in enumerate(want):
        assert np.array_equal(encode_texts([some[k]], small)[0], ids)


def test_pieces_tile_their_texts():
    some = fuzz(300, 5)
    pieces = Pieces(some, False)
    for text, a, b in zip(some, pieces.firsts, pieces.firsts[1:]):
        assert "".join(pieces.distinct[k] for k in pieces.numbers[a:b]) == text


def test_op4_is_the_librarys(spark):
    library = Tokenizer.from_file(bpe.vocabulary_path(bpe.WORD_VOCABULARY))
    rows = {r.doc_id: r for r in QUERIES["op4_bpe"](spark, SF).collect()}
    for i, text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_edges(spark):
    docs = edge_docs(spark)
    coded = bpe.decode(bpe.encode(docs), ids_col="ids_", into="decoded")
    assert coded.columns == [*docs.columns, "ids_", "decoded"]
    rows = coded.collect()
    assert len(rows) == len(edge_rows())
    assert all(r["ids_"] == [] and r["decoded"] == "" for r in rows if not (r["text"] or "").strip())
    assert len({(tuple(r["ids_"]), r["decoded"]) for r in rows if r["doc_id"] == 3}) == 1
    both = {r["doc_id"]: r["bpe_"] for r in bpe.round_trip(docs).collect()}
    assert both[6]["ids"] == next(r["ids_"] for r in rows if r["doc_id"] == 6)
    assert bpe.op4(docs.limit(0)).collect() == []
    nulls = spark.createDataFrame([(None,), ([518],)], "ids array<int>")
    assert [r.text for r in bpe.decode(nulls).collect()] == ["", "the</w>"]
