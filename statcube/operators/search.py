"""Keyword search: candidates, BM25 relevance, field boosts, evaluation.

The text of a catalog is read and tokenised once per search.  What a query needs of
a document (its length, the terms the query can reach, the token hits) is a short
row; those rows are checkpointed and every statistic comes from them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, functions as F

from statcube.functions.text import tokenize
from statcube.model import ENTITY, check_entity
from statcube.operators.scoring import HEAD_CHARS, expansions_of, query_tokens, reach_of, scored
from statcube.session import broadcast_within, cut_lineage

RRF_CONSTANT = 60
CUT_OFF = 50

TEXT_COLUMNS = ("df_description", "df_id", "cat_context")


def _present(catalog: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in catalog.columns]


def document_text(catalog: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> Column:
    """The searchable text of a dataflow: title, id and category names."""
    return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in _present(catalog, columns)])


def _token_hits(catalog: DataFrame, query: str, columns: Sequence[str]) -> tuple[Column, int]:
    """How many white-space separated words occur literally in any of the columns."""
    words = query.lower().split()
    texts = [F.lower(F.coalesce(c, F.lit(""))) for c in _present(catalog, columns)]
    found = [reduce(Column.__or__, [text.contains(w) for text in texts]) for w in words]
    return reduce(Column.__add__, [f.cast("int") for f in found], F.lit(0)), len(words)


def _accepted(hits: Column, n_words: int, best: Column) -> Column:
    """All words; only when no row has them all, any word."""
    if n_words < 2:
        return hits == n_words
    return (hits == n_words) | ((best < n_words) & (hits > 0))


def candidates(catalog: DataFrame, query: str, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Rows holding all words of the query as substrings, else rows holding any."""
    hits, n_words = _token_hits(catalog, query, columns)
    best = catalog.agg(F.max(hits)).scalar() if n_words > 1 else F.lit(0)
    return catalog.where(_accepted(hits, n_words, best))


def literal_search(catalog: DataFrame, query: str, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Search for a query without words, e.g. ``[``: substrings only, every score 1."""
    hits, n_words = _token_hits(catalog, query, columns)
    return catalog.where(hits == n_words).withColumn("score", F.lit(1.0))


# --- scoring one query -------------------------------------------------------


def _score(rows: DataFrame, tokens: Sequence[str], n_docs: Column, avg_length: Column) -> DataFrame:
    """Scores from counted rows of all documents the query touches."""
    frequency = rows.where("tf > 0").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    expansions = cut_lineage(expansions_of(frequency, tokens, n_docs))
    unit = expansions.agg(F.coalesce(F.avg("idf"), F.lit(1.0))).scalar()
    return scored(rows, tokens, broadcast_within(expansions), unit, avg_length)


def _reached(tokens: Column, starts: Sequence[str]) -> Column:
    return F.filter(tokens, lambda t: reduce(Column.__or__, [t.startswith(s) for s in starts]))


def _facts(
    docs: DataFrame, text: Column, tokens: Sequence[str], hits: Column
) -> tuple[DataFrame, Column, Column, Column]:
    """Short rows of the documents the query touches, and what the whole corpus says.

    This is the only pass over the text.  Number of documents, average length and the
    best number of hits are observed on all rows of that same pass; rows the query does
    not touch are then dropped, so the checkpoint is as long as the answer.
    """
    starts, corpus = reach_of(tokens), Observation()
    all_tokens = docs.select(*ENTITY, hits.alias("hits"), text.alias("_text")).withColumn(
        "_tokens", tokenize(F.col("_text"))
    )
    rows = all_tokens.select(
        *ENTITY, "hits", F.size("_tokens").alias("doc_length"),
        _reached(F.col("_tokens"), starts).alias("_terms"),
        _reached(tokenize(F.col("df_id")), starts).alias("_id_terms"),
        _reached(tokenize(F.substring("_text", 1, HEAD_CHARS)), starts).alias("_head_terms"),
    )
    seen = rows.observe(
        corpus, F.count(F.lit(1)).alias("n"), F.sum("doc_length").alias("words"), F.max("hits").alias("hits")
    )
    facts = cut_lineage(seen.where((F.col("hits") > 0) | (F.size("_terms") > 0)))
    # Without touched rows nothing is needed (an empty corpus may not even be observed).
    whole = {} if facts.isEmpty() else corpus.get
    n_docs, words = whole.get("n") or 0, whole.get("words") or 0
    average = words / n_docs if words else 1.0
    return facts, F.lit(n_docs), F.lit(float(average)), F.lit(whole.get("hits") or 0)


def _term_rows(facts: DataFrame) -> DataFrame:
    """Counted terms; a word's place in the joined arrays tells text, id and head apart."""
    words = facts.select(
        *ENTITY, "doc_length", F.size("_terms").alias("_id_from"),
        (F.size("_terms") + F.size("_id_terms")).alias("_head_from"),
        F.posexplode(F.concat("_terms", "_id_terms", "_head_terms")).alias("_place", "term"),
    )
    in_text, in_head = F.col("_place") < F.col("_id_from"), F.col("_place") >= F.col("_head_from")
    return words.groupBy(*ENTITY, "doc_length", "term").agg(
        F.count_if(in_text).alias("tf"), F.max(~in_text & ~in_head).alias("in_id"), F.max(in_head).alias("in_head")
    )


def bm25_search(docs: DataFrame, query: str, text: str = "text") -> DataFrame:
    """(provider, df_id, bm25, boost, score) of the documents scoring above zero."""
    check_entity(docs)
    tokens = query_tokens(query)
    if not tokens:
        return docs.select(*ENTITY, *[F.lit(0.0).alias(c) for c in ("bm25", "boost", "score")]).limit(0)
    body = F.coalesce(F.col(text), F.lit(""))
    facts, n_docs, avg_length, _ = _facts(docs, body, tokens, F.lit(0))
    return _score(_term_rows(facts), tokens, n_docs, avg_length)


def search(catalog: DataFrame, query: str, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Candidates with their relevance, best first; unscored candidates stay with 0.

    A dataflow is known by provider and id: the same id of another provider is another row.
    """
    check_entity(catalog)
    tokens = query_tokens(query)
    if not tokens:
        return literal_search(catalog, query, columns).orderBy("df_id", "provider")
    hits, n_words = _token_hits(catalog, query, columns)
    text = document_text(catalog, columns)
    facts, n_docs, avg_length, best = _facts(catalog, text, tokens, hits)
    scores = _score(_term_rows(facts), tokens, n_docs, avg_length).select(*ENTITY, "score")
    accepted = facts.where(_accepted(F.col("hits"), n_words, best)).select(*ENTITY)
    ranking = accepted.join(scores, [*ENTITY], "left").select(
        *ENTITY, F.coalesce("score", F.lit(0.0)).alias("score")
    )
    # Measured, so that the texts of the catalog are not shuffled to meet a short list.
    hits_only = broadcast_within(cut_lineage(ranking))
    return catalog.join(hits_only, [*ENTITY]).orderBy(F.desc("score"), "df_id", "provider")


def legacy_score(
    catalog: DataFrame, query: str, coverage_first: bool = False, columns: Sequence[str] = TEXT_COLUMNS
) -> DataFrame:
    """The earlier scorer, kept to compare with: counts of hits per field."""
    words = query.lower().split()
    title = F.lower(F.coalesce("df_description", F.lit("")))
    identifier = F.lower(F.coalesce("df_id", F.lit("")))
    score = F.lit(0)
    for word in words:
        occurrences = (F.length(title) - F.length(F.replace(title, F.lit(word), F.lit("")))) / F.lit(len(word))
        score = (
            score + identifier.contains(word).cast("int") * 3
            + F.substring(title, 1, HEAD_CHARS).contains(word).cast("int") * 2
            + occurrences.cast("int")
        )
        if "cat_context" in catalog.columns:
            score = score + F.lower(F.coalesce("cat_context", F.lit(""))).contains(word).cast("int")
    hits, _ = _token_hits(catalog, query, columns)
    ranked = catalog.withColumn("score", score)
    order = [F.desc("score"), F.col("df_id")]
    return ranked.orderBy(hits.desc(), *order) if coverage_first else ranked.orderBy(*order)


def paginate(
    df: DataFrame, n: int, order: Sequence[str], after: Sequence[object] | None = None
) -> tuple[list[Row], int, tuple | None]:
    """One page by cursor: its rows, the number of all rows, and the cursor of the next page (None at the end).

    ``order`` names columns that order the rows totally; a leading ``-`` means falling.  Nulls come last.
    ``after`` is the cursor of the page before: only rows behind it are ranked, so every page costs one pass and a
    top n, however deep it is.  The total is observed in that same pass.
    """
    if n < 1:
        raise ValueError("the size of a page starts at 1")
    total = Observation()
    counted = df.observe(total, F.count(F.lit(1)).alias("n"))
    names = [o.lstrip("-") for o in order]
    falling = [o.startswith("-") for o in order]
    if after is not None:
        if len(after) != len(names):
            raise ValueError(f"the cursor has {len(after)} values for {len(names)} columns")
        counted = counted.where(_behind(df, names, falling, after))
    sorting = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in zip(names, falling)]
    rows = counted.orderBy(*sorting).limit(n + 1).collect()
    page = rows[:n]
    end = tuple(page[-1][c] for c in names) if len(rows) > n else None
    # An empty page may end without a pass over the rows.
    return page, total.get["n"] if rows else df.count(), end


def _behind(df: DataFrame, names: Sequence[str], falling: Sequence[bool], after: Sequence[object]) -> Column:
    """Rows that follow a cursor: larger at the first column that differs."""
    behind = F.lit(False)
    for c, down, value in reversed(list(zip(names, falling, after))):
        column, last = F.col(c), F.lit(value).cast(df.schema[c].dataType)
        if value is None:
            behind = column.isNull() & behind
        else:
            further = column < last if down else column > last
            behind = F.coalesce(further, F.lit(True)) | (column.eqNullSafe(last) & behind)
    return behind


# --- evaluation --------------------------------------------------------------


def evaluate_ranking(runs: DataFrame, gold: DataFrame, k: int = 10, cut_off: int = CUT_OFF) -> DataFrame:
    """Mean reciprocal rank and success@k per run.

    ``runs``: run, query, provider, df_id, rank.  ``gold``: query, provider, df_id (any member of the
    family counts).  A query without a hit up to the cut-off counts as 0.
    """
    check_entity(runs, gold)
    queries = gold.select("query").distinct()
    names = runs.select("run").distinct()
    n_queries = queries.agg(F.count(F.lit(1)).alias("n")).scalar()
    best = (
        runs.where(F.col("rank") <= cut_off)
        .join(gold.select("query", *ENTITY).distinct(), ["query", *ENTITY], "left_semi")
        .groupBy("run", "query").agg(F.min("rank").alias("rank"))
    )
    per_run = best.groupBy("run").agg(
        F.sum(1.0 / F.col("rank")).alias("_reciprocal"), F.count_if(F.col("rank") <= k).alias("_success")
    )
    return names.join(per_run, "run", "left").select(
        "run", n_queries.alias("n_queries"),
        (F.coalesce("_reciprocal", F.lit(0.0)) / n_queries).alias("mrr"),
        (F.coalesce("_success", F.lit(0)) / n_queries).alias("success_at_k"),
    )


def rrf(runs: DataFrame, constant: int = RRF_CONSTANT) -> DataFrame:
    """Unweighted reciprocal rank fusion of runs (run, query, provider, df_id, rank)."""
    check_entity(runs)
    return runs.groupBy("query", *ENTITY).agg(F.sum(1.0 / (F.lit(constant) + F.col("rank"))).alias("score"))
