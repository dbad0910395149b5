"""The registered queries of this package, each beside its SQL where SQL can express it."""

from __future__ import annotations

import corpus_pipeline
from snaptrack.llm import (
    bpe, counts, decontaminate, fingerprints, langid, lloyd, mainpage, mixing, packing, pii, resample, simhash, vectors,
)
from snaptrack.llm.common import documents

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op8_main_text": lambda spark, sf: mainpage.op8(spark.read.parquet(f"{sf}/pages.parquet")),
    "op2_embeddings": lambda spark, sf: vectors.op2(spark.read.parquet(f"{sf}/embeddings.parquet")),
    "op1_fingerprints": lambda spark, sf: fingerprints.op1(documents(spark, sf)),
    "op7_personal_data": lambda spark, sf: pii.op7(documents(spark, sf)),
    "op3_language": lambda spark, sf: langid.op3(documents(spark, sf)),
    "op6_simhash": lambda spark, sf: simhash.op6(documents(spark, sf)),
    "op10_token_counts": lambda spark, sf: counts.op10(documents(spark, sf)),
    "op5_token_files": lambda spark, sf: packing.op5(documents(spark, sf)),
    "op4_bpe": lambda spark, sf: bpe.op4(documents(spark, sf)),
    "op9_mix": lambda spark, sf: mixing.op9(documents(spark, sf)),
    "op11_decontaminate": lambda spark, sf: decontaminate.op11(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")),
    "op12_resample": lambda spark, sf: resample.op12(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")),
    "op13_lloyd": lambda spark, sf: lloyd.op13(spark.read.parquet(f"{sf}/embeddings.parquet")),
}
ORACLES = {
    "op9_mix": mixing.ORACLE,
    "op11_decontaminate": decontaminate.ORACLE,
    "op12_resample": resample.ORACLE,
    "op13_lloyd": lloyd.ORACLE,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
