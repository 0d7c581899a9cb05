"""BM25 with prefix expansion and field boosts, shared by direct search and the stored index."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from statcube.model import ENTITY

# Fixed values of the ranking: Okapi constants, field boosts, weight of prefix hits.
K1 = 1.5
B = 0.75
ID_BOOST = 3.0
HEAD_BOOST = 2.0
HEAD_CHARS = 60
PREFIX_WEIGHT = 0.5


def query_tokens(query: str) -> list[str]:
    """Query words in order, repeats kept: runs of letters and digits."""
    return re.findall(r"[^\W_]+", query.lower())


def idf(n_docs: Column, df: Column) -> Column:
    return F.ln((n_docs - df + 0.5) / (df + 0.5) + 1.0)


def reach_of(tokens: Sequence[str]) -> list[str]:
    """Shortest starts that reach every token's exact and prefixed terms."""
    return [t for t in dict.fromkeys(tokens) if not any(t != o and t.startswith(o) for o in tokens)]


def expansions_of(terms: DataFrame, tokens: Sequence[str], n_docs: Column) -> DataFrame:
    """(term, idf, position, weight) of one query over the reachable vocabulary (term, df)."""
    # One subquery for all tokens: which of them occur as a whole term.
    flags = [F.coalesce(F.max(F.col("term") == t), F.lit(False)) for t in tokens]
    whole = terms.agg(F.array(*flags).alias("whole")).scalar()
    ways = []
    for i, token in enumerate(tokens):
        weight = F.when(F.col("term") == token, 1.0).when(
            F.col("term").startswith(token) & ~F.get(whole, F.lit(i)), PREFIX_WEIGHT
        )
        ways.append(F.struct(F.lit(i).alias("position"), weight.alias("weight")))
    return (
        terms.select("term", idf(n_docs, F.col("df")).alias("idf"), F.explode(F.array(*ways)).alias("_way"))
        .select("term", "idf", "_way.*")
        .where(F.col("weight").isNotNull())
    )


def scored(
    rows: DataFrame, tokens: Sequence[str], expansions: DataFrame, unit: Column, avg_length: Column
) -> DataFrame:
    """Scores with boosts from (provider, df_id, doc_length, term, tf, in_id, in_head) rows."""
    tf = F.col("tf").cast("double")
    part = (
        F.col("weight") * F.col("idf") * tf * (K1 + 1)
        / (tf + K1 * (1 - B + B * F.col("doc_length") / avg_length))
    )
    # One grouping: a position counts once for a field, however many of its terms are there.
    def hits(flag: str) -> Column:
        at = [F.max(F.when(F.col("position") == i, F.col(flag).cast("int")).otherwise(0)) for i in range(len(tokens))]
        return reduce(Column.__add__, at, F.lit(0))

    boost = unit * (ID_BOOST * hits("in_id") + HEAD_BOOST * hits("in_head")) / max(len(tokens), 1)
    return (
        rows.join(expansions, "term").groupBy(*ENTITY)
        .agg(F.sum(part).alias("bm25"), boost.alias("boost"))
        .where(F.col("bm25") > 0)
        .withColumn("score", F.col("bm25") + F.col("boost"))
    )
