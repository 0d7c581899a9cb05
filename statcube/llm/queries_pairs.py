"""Queries over the given tables that compare documents with each other or with the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from statcube.llm import decontamination, near_dedup, substring_dedup
from statcube.llm.common import table


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
