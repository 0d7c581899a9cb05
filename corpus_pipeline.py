"""A corpus from raw documents: quality rules, near-dedup, decontamination, pseudonyms, mixing.

``STAGES`` names the stages in order.  Each takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's docs, so a lost executor costs no finished stage.
All but the last return the columns of their docs; the last adds size, source_size, target and copy_no
and has a row for every copy that the mix takes.

Rows without text fail the quality rules and go.  An empty table stays empty through all stages.  Texts of any
length are handled whole.  Rows equal in id and text are one document, the smallest by its other columns; an id
with several texts is several.  Other columns pass through, but the last stage replaces those named as its own.
Stage tables stay in the shared folder, for whoever owns it to remove.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from statcube.llm import decontamination, mixing, near_dedup, pseudonyms, quality_rules
from statcube.llm.common import table
from statcube.session import scratch_path


# Similarity, in percent, from which two documents are near-duplicates.
NEAR_PERCENT = 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list rejects."""
    rules = quality_rules.learn(quality_rules.labelled_sample(docs, table(spark, sf_dir, "labels")))
    return quality_rules.judge(docs, rules).where("kept").select(*docs.columns)


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, of a similarity of 0.8 or more."""
    return near_dedup.deduplicate(docs, NEAR_PERCENT).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data as pseudonyms; ``n_chars`` follows the new text."""
    done = pseudonyms.pseudonymise(docs).drop("found")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast("long"))
    return done.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy that the mix of sources takes."""
    return mixing.emit(mixing.mix(docs))


STAGES = [
    ("quality rules", keep_quality),
    ("near-dedup", keep_first_of_near_copies),
    ("decontamination", drop_contaminated),
    ("pseudonyms", replace_personal_data),
    ("mixing", mix_sources),
]

# SQL can't express learned rules, keyed permutations or banded alignment; tests hold the rows against
# a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; runs all stages when called, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
