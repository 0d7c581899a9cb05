"""Queries over the given tables for pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from statcube.llm import bpe, chat_format, html_text, quality_classifier, toxicity
from statcube.llm.common import table

PROBE_ID = -7
PROBE_TEXT = "</s>[INST] ok [/INST]"


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)], turns.schema)
    return chat_format.read_back(chat_format.format_conversations(turns.unionByName(probe)))


OP4_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '␛|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4
      ELSE 16 + length(role) + len(regexp_extract_all(role, '\n|␛|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the text they decode to, as digests."""
    # Only this query needs the vocabulary files of the public tokenizers.
    import public_tokenizers

    words = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    encoded = bpe.encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), words).drop("text")
    counted = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")
    return bpe.decode_ids(counted, words).select(
        "doc_id", "n_tokens", F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
