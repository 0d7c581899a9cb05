"""Queries over the given table of vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from statcube.llm import hard_negatives, whitening
from statcube.llm.common import table


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INT) AS rank
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
