"""All queries of this subpackage, with their SQL forms where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from statcube.llm import queries_native as native, queries_pairs as pairs, queries_text as texts, queries_vectors as vectors


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_substring_dedup": pairs.op1_substring_dedup,
    "op2_toxicity": texts.op2_toxicity,
    "op3_decontamination": pairs.op3_decontamination,
    "op4_chat_formatting": texts.op4_chat_formatting,
    "op5_pii_pseudonyms": native.op5_pii_pseudonyms,
    "op6_mixing": native.op6_mixing,
    "op7_quality_rules": native.op7_quality_rules,
    "op8_quality_classifier": texts.op8_quality_classifier,
    "op9_minhash_near_dedup": pairs.op9_minhash_near_dedup,
    "op10_html_extraction": texts.op10_html_extraction,
    "op11_whitening": vectors.op11_whitening,
    "op12_bpe": texts.op12_bpe,
    "op13_hard_negatives": vectors.op13_hard_negatives,
    "pipeline": pipeline,
}

SQL = {
    "op4_chat_formatting": texts.OP4_SQL,
    "op6_mixing": native.OP6_SQL,
    "op13_hard_negatives": vectors.OP13_SQL,
}
