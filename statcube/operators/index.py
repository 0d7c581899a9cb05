"""A stored keyword index: postings, a term dictionary with block bounds, exact top-k retrieval.

Documents are dealt into blocks of similar length.  The dictionary has one row per provider, term and block:
how many documents hold the term there, its largest frequency, the shortest of these documents, and whether it occurs
in an id or a head.  Document frequencies are sums over these few rows, and a query bounds the best
score of every block from them, so blocks that can't reach the k-th best score are never read.

Both tables are dealt by term and block, each file sorted by term, so a query reads the pages with the terms it can reach.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from statcube.functions.text import tokenize
from statcube.model import ENTITY, check_entity
from statcube.operators.scoring import (
    B, HEAD_BOOST, HEAD_CHARS, ID_BOOST, K1, PREFIX_WEIGHT, expansions_of, idf, query_tokens, reach_of, scored,
)
from statcube.session import broadcast_within, cut_lineage

# Documents of similar length are spread over so many blocks that each holds about this number.
BLOCK_DOCS = 512
# Classes of length per doubling.
LENGTH_CLASSES = 1
# Dictionary rows that the driver weighs itself (some 10 MB); a query that reaches more has them weighed by tasks.
LOCAL_ROWS = 50_000
# Up to so many reached postings skipping blocks costs more than it saves.
FEW_POSTINGS = 250_000
# Blocks scored first, for a lower bound of the k-th score.
FIRST_BLOCKS = 16
# Bounds are sums of doubles in another order than scores: room for rounding.
SLACK = 1 + 1e-9


def _type(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_S, _I, _L, _B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
POSTINGS = _type(
    ("provider", _S), ("df_id", _S), ("doc_length", _I), ("block", _L), ("term", _S), ("tf", _I), ("in_id", _B), ("in_head", _B))
DICTIONARY = _type(
    ("provider", _S), ("term", _S), ("block", _L), ("df", _L), ("words", _L), ("max_tf", _I), ("min_length", _I),
    ("in_id", _B), ("in_head", _B))
SIZE = _type(("provider", _S), ("n_docs", _L), ("n_words", _L))


@dataclass(frozen=True)
class Index:
    postings: DataFrame
    dictionary: DataFrame
    size: DataFrame

    def of(self, provider: str | None) -> Index:
        """The index of one provider: its documents, its statistics."""
        if provider is None:
            return self
        mine = F.col("provider") == provider
        return Index(self.postings.where(mine), self.dictionary.where(mine), self.size.where(mine))


def _counted(tokens: Column) -> Column:
    """Distinct tokens with their number, from one sort of the row's own tokens."""

    def runs(words: Column, starts: Column) -> Column:
        after = lambda i: F.coalesce(F.get(starts, i + 1), F.size(words))
        return F.transform(starts, lambda at, i: F.struct(F.get(words, at).alias("term"), (after(i) - at).alias("tf")))

    def counted(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))
        return F.transform(F.array(starts), lambda s: runs(words, s))[0]

    # The sorted words and the starts are lambda variables, so that they are built once per row.
    some = F.transform(F.array(F.sort_array(tokens)), counted)[0]
    return F.when(F.size(tokens) > 0, some).otherwise(F.array().cast("array<struct<term:string,tf:int>>"))


def postings(docs: DataFrame, text: str = "text", blocks: int = 1) -> DataFrame:
    """Terms of every document, counted inside its row: nothing is shuffled.

    Terms found only in the id or cut off at the end of the head have tf 0.  ``blocks`` is the number of blocks
    of each class of length.
    """
    check_entity(docs)
    body = F.coalesce(text, F.lit(""))
    tokens = docs.select(
        *ENTITY, tokenize(body).alias("_terms"), tokenize(F.col("df_id")).alias("_id_terms"),
        tokenize(F.substring(body, 1, HEAD_CHARS)).alias("_head_terms"))
    length = F.size("_terms")
    kind = F.floor(F.log2(length + 1) * LENGTH_CLASSES)
    block = kind * 2**32 + F.pmod(F.xxhash64(*ENTITY), F.lit(blocks))
    others = F.array_except(F.array_union("_id_terms", "_head_terms"), F.col("_terms"))
    unseen = F.transform(others, lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf")))
    # The words end here: next to the rows of a document they would be copied into each of them.
    counted = tokens.select(
        *ENTITY, length.alias("doc_length"), block.alias("block"), "_id_terms", "_head_terms",
        _counted(F.col("_terms")).alias("_counted"), unseen.alias("_unseen"))
    rows = counted.select(
        *ENTITY, "doc_length", "block", "_id_terms", "_head_terms", F.inline(F.concat("_counted", "_unseen")).alias("term", "tf"))
    return rows.select(
        *ENTITY, "doc_length", "block", "term", "tf", F.array_contains("_id_terms", F.col("term")).alias("in_id"),
        F.array_contains("_head_terms", F.col("term")).alias("in_head"))


def dictionary(index_rows: DataFrame) -> DataFrame:
    """One row per provider, term and block."""
    held = F.col("tf") > 0
    return index_rows.groupBy("provider", "term", "block").agg(
        F.count_if(held).alias("df"), F.sum("tf").alias("words"), F.max("tf").alias("max_tf"),
        F.coalesce(F.min(F.when(held, F.col("doc_length"))), F.lit(0)).alias("min_length"),
        F.max("in_id").alias("in_id"), F.max("in_head").alias("in_head"))


def write_index(docs: DataFrame, path: str, text: str = "text") -> None:
    """Store the index; the text is read once.

    The block is part of the key, so a term of every document is not one task.
    """
    check_entity(docs)
    spark, root = docs.sparkSession, path.rstrip("/")
    counts = {r["provider"]: r["n"] for r in docs.groupBy("provider").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = max(1, math.ceil(sum(counts.values()) / BLOCK_DOCS / 8))
    order = ["term", "provider", "block"]
    # By a hash, since a range would be sampled first, which reads the text twice.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = postings(docs, text, blocks).repartition(parts, "term", "block").sortWithinPartitions(*order)
    rows.write.mode("overwrite").parquet(f"{root}/terms")
    # Stays where the grouping puts it: a range would be sampled first, which needs a copy of the dictionary.
    terms = dictionary(spark.read.schema(POSTINGS).parquet(f"{root}/terms"))
    terms.sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{root}/dictionary")
    words = spark.read.schema(DICTIONARY).parquet(f"{root}/dictionary").groupBy("provider").agg(F.sum("words").alias("n_words"))
    sizes = spark.createDataFrame([(p, n) for p, n in counts.items()], "provider string, n_docs long")
    sized = sizes.join(words, sizes["provider"].eqNullSafe(words["provider"]), "left").select(
        sizes["provider"], "n_docs", F.coalesce("n_words", F.lit(0)).alias("n_words"))
    sized.coalesce(1).write.mode("overwrite").parquet(f"{root}/size")


def read_index(spark: SparkSession, path: str) -> Index:
    """The index as stored; no file is opened to learn a schema."""
    root = path.rstrip("/")
    parts = (("terms", POSTINGS), ("dictionary", DICTIONARY), ("size", SIZE))
    return Index(*[spark.read.schema(schema).parquet(f"{root}/{name}") for name, schema in parts])


def corpus_size(index: Index) -> DataFrame:
    """One row: number of documents and average length (1 for an empty corpus)."""
    total = index.size.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("_words"))
    average = F.col("_words") / F.nullif(F.col("n_docs"), F.lit(0))
    return total.select("n_docs", F.when(average > 0, average).otherwise(1.0).alias("avg_length"))


def bm25_stats(index: Index) -> DataFrame:
    """Document frequency and idf of every term, summed from the dictionary's blocks."""
    n_docs = corpus_size(index).select("n_docs").scalar()
    found = index.dictionary.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
    return found.withColumn("idf", idf(n_docs, F.col("df")))


@dataclass(frozen=True)
class _Asked:
    """What a query reaches: its tokens, the weighed terms, the corpus, and what bounds its blocks."""

    tokens: list[str]
    reached: Column
    expansions: DataFrame
    unit: Column
    avg_length: float
    n_postings: int
    # Block to bound; None when so many dictionary rows are reached that tasks bound the blocks.
    bounds: dict[int, float] | None


def _ask(index: Index, query: str) -> _Asked:
    """The dictionary rows that the query reaches: weights and bounds come from them.

    Which tokens are terms is asked first, so that the terms behind them are not read.
    """
    tokens = query_tokens(query)
    exact = index.dictionary.where(F.col("term").isin(tokens) & (F.col("df") > 0)).select("term").distinct()
    whole = {r["term"] for r in exact.collect()} if tokens else set()
    ways = [F.col("term") == t for t in sorted(whole)]
    ways += [F.col("term").startswith(s) for s in reach_of([t for t in tokens if t not in whole])]
    reached = reduce(Column.__or__, ways, F.lit(False))
    sizes = index.size.collect()
    n_docs, words = sum(r["n_docs"] for r in sizes), sum(r["n_words"] for r in sizes)
    average = words / n_docs if words else 1.0
    mine = index.dictionary.where(reached)
    listed = F.collect_list(F.struct("term", "block", "df", "max_tf", "min_length", "in_id", "in_head"))
    rows = mine.limit(LOCAL_ROWS + 1).agg(listed).first()[0]
    if len(rows) > LOCAL_ROWS:
        frequency = mine.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
        expansions = cut_lineage(expansions_of(frequency, tokens, F.lit(n_docs)))
        unit = expansions.agg(F.coalesce(F.avg("idf"), F.lit(1.0))).scalar()
        return _Asked(tokens, reached, broadcast_within(expansions), unit, average, len(rows), None)
    held: dict[str, int] = {}
    for r in rows:
        held[r["term"]] = held.get(r["term"], 0) + r["df"]
    weighed = []
    for term, df in held.items():
        if df:
            weight = math.log((n_docs - df + 0.5) / (df + 0.5) + 1.0)
            for position, token in enumerate(tokens):
                if term == token or (not held.get(token) and term.startswith(token)):
                    weighed.append((term, weight, position, 1.0 if term == token else PREFIX_WEIGHT))
    unit = sum(w[1] for w in weighed) / len(weighed) if weighed else 1.0
    local = index.dictionary.sparkSession.createDataFrame(weighed, "term string, idf double, position int, weight double")
    return _Asked(tokens, reached, F.broadcast(local), F.lit(unit), average, sum(held.values()), _bounds(rows, weighed, unit, average, len(tokens)))


def _bounds(rows: list, weighed: list[tuple], unit: float, average: float, n_tokens: int) -> dict[int, float]:
    """As :func:`block_bounds`, from rows at hand."""
    ways: dict[str, list[tuple[int, float]]] = {}
    for term, weight, position, share in weighed:
        ways.setdefault(term, []).append((position, weight * share))
    best: dict[tuple[int, int, str], float] = {}
    for r in rows:
        boost = unit * (ID_BOOST * r["in_id"] + HEAD_BOOST * r["in_head"]) / n_tokens
        saturated = r["max_tf"] * (K1 + 1) / (r["max_tf"] + K1 * (1 - B + B * r["min_length"] / average))
        for position, weight in ways.get(r["term"], ()):
            key = (r["block"], position, r["term"])
            best[key] = max(best.get(key, 0.0), weight * saturated + boost)
    bounds: dict[int, float] = {}
    for (block, _, _), value in best.items():
        bounds[block] = bounds.get(block, 0.0) + value * SLACK
    return bounds


def _score(rows: DataFrame, asked: _Asked) -> DataFrame:
    return scored(rows.where(asked.reached), asked.tokens, asked.expansions, asked.unit, F.lit(asked.avg_length))


def bm25_score(index: Index, query: str) -> DataFrame:
    """(provider, df_id, bm25, boost, score) of all documents scoring above zero; no text is read.

    The starts of the query's words reach the file scans as filters.
    """
    return _score(index.postings, _ask(index, query))


def block_bounds(index: Index, asked: _Asked) -> DataFrame:
    """(block, bound): no document of the block scores more, whichever terms it holds."""
    tf = F.col("max_tf").cast("double")
    part = F.col("weight") * F.col("idf") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("min_length") / F.lit(asked.avg_length)))
    boost = asked.unit * (ID_BOOST * F.col("in_id").cast("int") + HEAD_BOOST * F.col("in_head").cast("int")) / len(asked.tokens)
    # Over providers a block is one: its largest row per term stands for all.
    best = F.max(F.coalesce(part, F.lit(0.0)) + boost)
    return (
        index.dictionary.where(asked.reached).join(asked.expansions, "term").groupBy("block", "position", "term").agg(best.alias("_best"))
        .groupBy("block").agg((F.sum("_best") * SLACK).alias("bound")))


def bm25_top(index: Index, query: str, k: int) -> DataFrame:
    """The first ``k`` rows of :func:`bm25_score` by score, provider and id, without scoring every block.

    The blocks with the highest bounds are scored first; their k-th score is a floor, and only
    blocks whose bound reaches it are read after that.  The result is exact.  A query that reaches few postings is
    scored in one pass.
    """
    asked = _ask(index, query)
    spark, order = index.dictionary.sparkSession, [F.desc("score"), *ENTITY]
    if asked.bounds is not None and asked.n_postings <= FEW_POSTINGS:
        return _score(index.postings, asked).orderBy(*order).limit(k)
    if asked.bounds is None:
        bounds = cut_lineage(block_bounds(index, asked))
        ahead = [(r["block"], r["bound"]) for r in bounds.orderBy(F.desc("bound"), "block").limit(FIRST_BLOCKS + 1).collect()]
    else:
        ahead = sorted(asked.bounds.items(), key=lambda b: (-b[1], b[0]))
        bounds = spark.createDataFrame(ahead[FIRST_BLOCKS:], "block long, bound double")
    chosen = [block for block, _ in ahead[:FIRST_BLOCKS]]
    best = _score(index.postings.where(F.col("block").isin(chosen)), asked).orderBy(*order).limit(k)
    if len(ahead) <= FIRST_BLOCKS:
        return best
    rows = best.collect()
    found = spark.createDataFrame(rows, best.schema)
    floor = rows[-1]["score"] if len(rows) == k else 0.0
    if ahead[FIRST_BLOCKS][1] < floor:
        return found.orderBy(*order)
    more = bounds.where((F.col("bound") >= floor) & ~F.col("block").isin(chosen)).select("block")
    rest = _score(index.postings.join(more, "block", "left_semi"), asked)
    return found.unionByName(rest).orderBy(*order).limit(k)
