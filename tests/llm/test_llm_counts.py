import random

import pytest
from llm_cases import SF, edge_docs, edge_rows, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snaptrack.llm import counts
from snaptrack.llm.bpe import BYTE_VOCABULARY, WORD_VOCABULARY, encoder, vocabulary_path
from snaptrack.llm.characters import assignable, text_of
from snaptrack.llm.pretokens import Pieces
from snaptrack.llm.queries import QUERIES


@pytest.fixture(scope="module")
def size():
    library = Tokenizer.from_file(vocabulary_path(BYTE_VOCABULARY))
    library.encode_special_tokens = True
    return lambda text: len(library.encode(text, add_special_tokens=False).ids)


def test_trees_count_what_encoding_all_anew_counts(size):
    e, rnd, signs = encoder(vocabulary_path(BYTE_VOCABULARY)), random.Random(3), "ab \n\t  'sé1.,中"
    for _ in range(400):
        text = "".join(rnd.choice(signs) for _ in range(rnd.choice([0, 1, 5, 30, 200])))
        tree = counts.TokenTree.of(text, e)
        for _ in range(6):
            start = rnd.randint(-1, len(text) + 2)
            end = start + rnd.choice([-1, 0, 0, 1, 3, 40])
            new = "".join(rnd.choice(signs) for _ in range(rnd.choice([0, 1, 2, 20])))
            tree.edit(start, end, new)
            low = min(max(start, 0), len(text))
            text = text[:low] + new + text[min(max(end, low), len(text)) :]
            assert (tree.text(), tree.n_chars, tree.n_tokens) == (text, len(text), size(text))


def test_only_a_stretch_is_encoded_again():
    tree = counts.TokenTree.of("word " * 20_000, encoder(vocabulary_path(BYTE_VOCABULARY)))
    tree.edit(50_000, 50_003, "another")
    assert 0 < tree.encoded < 300


def test_leaves_stay_short_whatever_is_inserted(size):
    tree = counts.TokenTree.of("word " * 300, encoder(vocabulary_path(BYTE_VOCABULARY)))
    text, large = tree.text(), "more words, " * 17_000
    tree.edit(700, 700, large)
    text = text[:700] + large + text[700:]
    for at in (699, 701, 100_000, 700 + len(large), 5):
        before = tree.encoded
        tree.edit(at, at, "x")
        text = text[:at] + "x" + text[at:]
        assert tree.encoded - before < 1000
        assert (tree.text(), tree.n_tokens) == (text, size(text))
    # Typed sign by sign at one place, and taken out again.
    for k in range(600):
        tree.edit(2000 + k, 2000 + k, "ab, "[k % 4])
    text = text[:2000] + "ab, " * 150 + text[2000:]
    assert (tree.text(), tree.n_tokens) == (text, size(text)) and tree.encoded < 700_000
    tree.edit(10, len(text) - 10, "")
    assert (tree.text(), tree.n_tokens) == (text[:10] + text[-10:], size(text[:10] + text[-10:]))


def test_short_texts_have_the_pieces_of_long_ones():
    """For every code point, in several surroundings."""
    chars = text_of(assignable())
    for around in ("a{}b", " {}", "{}1", "'{}s", "{} {}"):
        some = [around.replace("{}", c) for c in chars]
        for at in range(0, len(some), 20_000):
            own = some[at : at + 20_000]
            pieces = Pieces(own, False)
            for text, a, b in zip(own, pieces.firsts, pieces.firsts[1:]):
                assert [pieces.distinct[k] for k in pieces.numbers[a:b]] == counts.short_pieces(text), ascii(text)


def test_op10(spark, size):
    rows = {r.doc_id: r for r in QUERIES["op10_token_counts"](spark, SF).collect()}
    for i, text in texts():
        n = len(text)
        new = text[: n // 2] + text[:20] + text[n // 2 :]
        new = new[: n * 3 // 4] + new[n * 3 // 4 + 12 :] + " (end)"
        assert (rows[i].n_tokens, rows[i].edited_tokens, rows[i].edited_chars) == (size(text), size(new), len(new))


def test_edges(spark):
    docs = edge_docs(spark)
    found = counts.count_tokens(docs, counts.sample_edits(F.col("text")))
    assert found.columns[-1] == "counts_" and found.count() == len(edge_rows())
    none = F.lit(None).cast("array<struct<start:int,end:int,replacement:string>>")
    by_id = {r.doc_id: r["counts_"] for r in counts.count_tokens(docs, none).collect()}
    assert by_id[2].n_tokens == by_id[2].edited_tokens == 0
    assert by_id[6].n_tokens == by_id[6].edited_tokens > 1000
    odd = F.expr("array(null, struct(cast(null as int) as start, cast(null as int) as end, cast(null as string) as replacement))")
    assert all(r["counts_"].edited_text == (r.text or "") for r in counts.count_tokens(docs, odd).collect())
    assert counts.op10(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        next(counts.counted_pieces(["a"], encoder(vocabulary_path(WORD_VOCABULARY))))
