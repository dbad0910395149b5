"""Every stage against a brute-force version of its decision, on its own input."""

import numpy as np
import pytest
from llm_cases import SF, edge_docs
from pyspark.sql import functions as F
from test_llm_simhash import roots, slow_simhash
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from snaptrack.llm import bpe, mixing, pii
from snaptrack.llm.queries import ORACLES, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [[r.asDict() for r in docs.collect()]]
    for name, stage in pipeline.STAGES:
        docs = pipeline.written(stage(spark, docs, SF), f"test-{name}")
        found.append([r.asDict() for r in docs.collect()])
    return found


def test_stages_keep_the_columns(stages):
    assert [len(pipeline.STAGES), [n for n, _ in pipeline.STAGES]] == [5, ["language", "copies", "personal", "mix", "tokens"]]
    assert all(list(rows[0]) == COLUMNS for rows in stages[:-1])
    assert list(stages[-1][0]) == ["doc_id", "n_tokens", "ids", "decoded"]


def test_language_rejects_nothing_that_has_words(stages):
    before, after = stages[0], stages[1]
    kept = {r["doc_id"]: r for r in after}
    assert all(r["doc_id"] in kept for r in before if any(c.isalpha() for c in r["text"] or ""))
    assert all(kept[r["doc_id"]]["text"] == r["text"] for r in before if r["doc_id"] in kept)
    right = [kept[r["doc_id"]]["lang"] == r["lang"] for r in before if r["doc_id"] in kept]
    assert sum(right) / len(right) > 0.95


def test_copies_leave_one_of_each_group(stages):
    before, after = sorted(stages[1], key=lambda r: r["doc_id"]), stages[2]
    words = np.array([slow_simhash(r["text"]) for r in before], np.uint64)
    want = [r for k, r in enumerate(before) if roots(words)[k] == k]
    assert sorted(after, key=lambda r: r["doc_id"]) == want and len(want) < len(before)


def test_personal_data_is_masked_and_nothing_else(stages):
    after = {r["doc_id"]: r for r in stages[3]}
    for r in stages[2]:
        new, base = after[r["doc_id"]], pii.base_spans(r["text"])
        assert new["n_chars"] == len(new["text"]) and not pii.base_spans(new["text"])
        if not base:
            assert new["text"].count("[") >= r["text"].count("[")
        else:
            assert pii.mask_text(r["text"], base).count("[") <= new["text"].count("[")
    same = [after[r["doc_id"]]["text"] == r["text"] for r in stages[2] if not pii.base_spans(r["text"])]
    assert sum(same) >= 0.99 * len(same)


def test_the_mix_takes_what_its_plan_says(spark, stages):
    docs = spark.createDataFrame([tuple(r.values()) for r in stages[3]], "doc_id long, text string, lang string, source string, n_chars long")
    plan = {r.doc_id: r.mix.taken for r in mixing.mix(docs).collect() if r.mix.taken}
    taken = {}
    for r in stages[4]:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert taken == plan


def test_tokens_are_the_librarys(stages):
    library = Tokenizer.from_file(bpe.vocabulary_path(bpe.WORD_VOCABULARY))
    want = sorted((r["doc_id"], library.encode(r["text"], add_special_tokens=False).ids) for r in stages[4])
    assert sorted((r["doc_id"], r["ids"]) for r in stages[5]) == want
    assert all(r["n_tokens"] == len(r["ids"]) and r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) for r in stages[5])


def test_running_it_all_gives_the_stages_rows(spark, stages):
    assert pipeline.ORACLE_SQL is None and "pipeline" not in ORACLES
    rows = QUERIES["pipeline"](spark, SF).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, rows)) == sorted((r["doc_id"], r["n_tokens"]) for r in stages[5])


def test_edges(spark):
    docs = edge_docs(spark).drop("fp")
    for _, stage in pipeline.STAGES[:-1]:
        docs = pipeline.written(stage(spark, docs, SF), "test-edges")
        assert docs.columns == edge_docs(spark).drop("fp").columns
    found = pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in found.collect()} <= {3, 6, 7, 8, 9, None}
    none = edge_docs(spark).limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, SF).collect() == []
    blank = edge_docs(spark).filter("doc_id in (1, 2)")
    assert pipeline.language(spark, blank, SF).collect() == []
    assert pipeline.copies(spark, blank.withColumn("extra", F.lit(1)), SF).count() == 1
