"""A corpus from raw documents: language, near copies, personal data, source mix, token ids.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the
last return the columns of `documents` (and any further columns of their input); decisions are in
the rows and texts:

language    documents whose language cannot be told (null text, or no letter) go; `lang` is the
            predicted language; learned from the rows with a language
copies      one document of each group of near copies stays, the one with the smallest id
personal    spans of personal data are replaced by their kind in brackets
mix         each document comes as often, and with those of its words, as the mix takes
tokens      doc_id, n_tokens, ids and the text decoded from them, a row for each row of the mix

Defined results: null texts go in the first stage; a null id stays only if no near copy has one; a
null source is a source; repeated rows are near copies and leave one row; empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrack.llm import bpe, langid, mixing, pii, simhash
from snaptrack.llm.common import col, documents, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = langid.predict(docs, langid.fit(docs))
    found = F.col(marked.columns[-1])
    kept = marked.filter(found["lang_pred"] != langid.UNKNOWN)
    return kept.select(*(found["lang_pred"].alias(c) if c == "lang" else col(c) for c in docs.columns))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only (id, fingerprint, place) rows are grouped; texts are shuffled once, to the places kept."""
    return simhash.keep_one(docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.mask(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(docs.select("doc_id", "text"))
    return coded.select(
        "doc_id", F.size("bpe.ids").cast("long").alias("n_tokens"), F.col("bpe.ids").alias("ids"),
        F.col("bpe.decoded").alias("decoded"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("copies", copies), ("personal", personal), ("mix", mix), ("tokens", tokens),
]

#: SQL cannot express the trained stages; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
