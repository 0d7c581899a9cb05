"""Queries over the given tables for the operators written in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statcube.llm import mixing, pseudonyms, quality_rules
from statcube.llm.common import table


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), per AS (
  SELECT source, count(*) AS n, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM per
), marked AS (
  SELECT source, n, s, w, s = 0 OR 3 * s * (all_w - upto_w) <= w * (all_s - 3 * upto_s) AS is_capped
  FROM (SELECT *, sum(w) OVER () AS all_w, sum(s) OVER () AS all_s,
          sum(w) OVER (ORDER BY s * (10 // w)) AS upto_w, sum(s) OVER (ORDER BY s * (10 // w)) AS upto_s FROM weighed)
), rest AS (
  SELECT CAST(sum(s) - 3 * coalesce(sum(s) FILTER (is_capped), 0) AS DOUBLE) AS words,
         CAST(sum(w) FILTER (NOT is_capped) AS DOUBLE) AS weight FROM marked
), targets AS (
  SELECT source, n, s, CASE WHEN is_capped THEN CAST(3 * s AS DOUBLE) ELSE w * (words / weight) END AS target FROM marked, rest
), placed AS (
  SELECT doc_id, size, t.source, n, s, target,
    floor(CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix:chunk'), 1, 8) AS BIGINT) AS DOUBLE)
      / 4294967296.0 * ceil(n / 2000)) AS chunk,
    CAST(CAST('0x' || substr(md5(coalesce(t.source, '') || ':mix'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u
  FROM sized JOIN targets t ON sized.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, CASE WHEN s > 0 THEN target / CAST(s AS DOUBLE) ELSE 0 END AS rate,
    CAST(row_number() OVER (PARTITION BY source ORDER BY chunk, CASE WHEN chunk % 2 = 0 THEN size ELSE -size END, doc_id) AS DOUBLE) AS k
  FROM placed
)
SELECT doc_id, size, s AS source_size, target,
  size * CAST(least(floor(u + rate * k) - floor(u + rate * (k - 1)), 3) AS BIGINT) AS taken
FROM ranked
"""


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.learn(quality_rules.labelled_sample(docs, table(spark, sf_dir, "labels")))
    return quality_rules.judge(docs, rules).select("doc_id", *quality_rules.BASE, "base_failed", "rule", "kept")


def _found(kind: str) -> Column:
    return F.size(F.filter("found", lambda f: f["kind"] == kind)).cast("long")


def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its pseudonymised text, and how many values of each kind were replaced."""
    done = pseudonyms.pseudonymise(table(spark, sf_dir, "documents"))
    counts = [_found(k).alias(f"n_{k}") for k in pseudonyms.KINDS]
    return done.select("doc_id", "text", *counts)
