"""Embedding texts, building vectors and ranking by cosine similarity."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from statcube.functions.vectors import NORM_FLOOR
from statcube.model import EMBEDDINGS, ENTITY, check_entity
from statcube.operators.series import ranked

DOCUMENT_PREFIX = "search_document: "
# Vectors and queries that meet in one matrix product.
VECTOR_ROWS, QUERY_ROWS = 2048, 512
# Query blocks up to this size go to every executor; more are dealt out with the vector blocks.
BROADCAST_BYTES = 32 * 1024 * 1024
# Vector blocks that one task of the dealt join meets.
GROUP = 32


def embedding_text(catalog: DataFrame, context: DataFrame, prose: DataFrame) -> DataFrame:
    """Text to embed per dataflow: id, title, categories, prose, keywords and notes."""
    check_entity(catalog, context, prose)
    joined = catalog.join(context.select(*ENTITY, "cat_context"), [*ENTITY], "left").join(
        prose.select(*ENTITY, F.col("description").alias("df_prose")), [*ENTITY], "left"
    )
    parts = ["df_id", "df_description", "cat_context", "df_prose", "df_keywords", "df_notes"]
    filled = [F.nullif(F.col(c), F.lit("")) for c in parts if c in joined.columns]
    return joined.select(*ENTITY, F.trim(F.concat_ws(" ", *filled)).alias("text"))


def build_embeddings(
    texts: DataFrame, embed: Callable[[list[str]], Sequence[Sequence[float]]], batch: int = 256
) -> DataFrame:
    """One vector per document; ``embed`` maps a list of texts to a list of vectors."""
    check_entity(texts)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            prefixed = [DOCUMENT_PREFIX + t for t in frame["text"].fillna("")]
            vectors = []
            for start in range(0, len(prefixed), batch):
                vectors.extend([float(x) for x in v] for v in embed(prefixed[start:start + batch]))
            yield pd.DataFrame({"provider": frame["provider"], "df_id": frame["df_id"], "embedding": vectors})

    return texts.select(*ENTITY, "text").mapInPandas(run, EMBEDDINGS)


# --- ranking -------------------------------------------------------------------


def _unit_rows(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows of length 1; a zero vector stays zero."""
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    return rows / (np.linalg.norm(rows, axis=1, keepdims=True) + NORM_FLOOR)


def _best(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, document) places of each row's n best scores; scores equal to the n-th all stay."""
    if scores.shape[1] <= n:
        return tuple(g.ravel() for g in np.indices(scores.shape))
    cut = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]
    return np.nonzero(scores >= cut[:, None])


def _usable(vectors: DataFrame, catalog: DataFrame) -> DataFrame:
    """Vectors of the catalog's dataflows; only ids are joined."""
    check_entity(vectors, catalog)
    return vectors.select(*ENTITY, "embedding").where("embedding IS NOT NULL").join(catalog.select(*ENTITY), [*ENTITY], "left_semi")


def _described(hits: DataFrame, catalog: DataFrame) -> DataFrame:
    """The catalog's titles for the rows that are left."""
    return hits.join(catalog.select(*ENTITY, "df_description"), [*ENTITY])


def semantic_top_n(vectors: DataFrame, query: Sequence[float], catalog: DataFrame, n: int) -> DataFrame:
    """The n most similar dataflows of the catalog; vectors of others are not ranked.

    Each task multiplies its vectors with the query and hands on its n best.
    """
    wanted = np.array(query, np.float64)
    wanted = wanted / (np.linalg.norm(wanted) + NORM_FLOOR)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = _unit_rows(batch.column("embedding")) @ wanted
                _, places = _best(scores[None, :], n)
                kept = batch.select([*ENTITY]).take(pa.array(places))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(scores[places])], names=[*ENTITY, "score"])

    near = _usable(vectors, catalog).mapInArrow(run, "provider string, df_id string, score double")
    top = near.orderBy(F.desc("score"), "df_id", "provider").limit(n)
    return _described(top, catalog).select(*ENTITY, "df_description", "score").orderBy(F.desc("score"), "df_id", "provider")


def _numbers(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _query_blocks(queries: DataFrame, n_blocks: int) -> DataFrame:
    """block and its queries as one matrix; a block holds about ``QUERY_ROWS``, dealt by a hash."""
    dealt = queries.select("query", "embedding").where("embedding IS NOT NULL").withColumn(
        "block", F.pmod(F.xxhash64("query", "embedding"), F.lit(n_blocks)))

    def pack(group: pa.Table) -> pa.Table:
        packed = pickle.dumps((group.column("query").to_pylist(), _unit_rows(group.column("embedding").combine_chunks())), 5)
        return pa.table({"block": group.column("block")[:1], "queries": pa.array([packed], pa.binary())})

    return dealt.groupBy("block").applyInArrow(pack, "block long, queries binary")


def _vector_blocks(vectors: DataFrame) -> DataFrame:
    """Vectors of a task, packed by the ``VECTOR_ROWS``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, VECTOR_ROWS):
                some = batch.slice(start, VECTOR_ROWS)
                packed = pickle.dumps((*[some.column(c).to_pylist() for c in ENTITY], _unit_rows(some.column("embedding"))), 5)
                yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["vectors"])

    return vectors.mapInArrow(run, "vectors binary")


def semantic_batch(vectors: DataFrame, queries: DataFrame, catalog: DataFrame, n: int) -> DataFrame:
    """``semantic_top_n`` for a table of queries (query, embedding), with ranks.

    Queries and vectors become blocks, and each pair of blocks meets in a task: one matrix product, of which the n
    best per query are handed on.  The driver sees only two numbers, of queries and of their components.
    """
    usable = _usable(vectors, catalog)
    kind = queries.schema["query"].dataType
    shape = queries.agg(F.count("embedding").alias("n"), F.max(F.size("embedding")).alias("d")).first()
    n_blocks = max(1, ceil(shape["n"] / QUERY_ROWS))
    asked = _query_blocks(queries, n_blocks)
    every = _vector_blocks(usable).withColumn("block", _numbers(n_blocks))
    if shape["n"] * (shape["d"] or 0) * 8 <= BROADCAST_BYTES:
        met = every.join(F.broadcast(asked), "block")
    else:
        part = F.pmod(F.xxhash64("vectors"), F.lit(GROUP))
        met = every.withColumn("part", part).join(asked.withColumn("part", _numbers(GROUP)), ["block", "part"])
    schema = T.StructType([T.StructField("query", kind), *[T.StructField(c, T.StringType()) for c in ENTITY], T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column("queries"), batch.column("vectors")):
                ids, wanted = pickle.loads(left.as_buffer())
                providers, flows, rows = pickle.loads(right.as_buffer())
                scores = wanted @ rows.T
                q, d = _best(scores, n)
                picked = [[ids[i] for i in q], [providers[i] for i in d], [flows[i] for i in d]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(picked[0], to_arrow_type(kind)), *[pa.array(p, pa.string()) for p in picked[1:]], pa.array(scores[q, d])], names=schema.names)

    best_first = [F.desc("score"), F.col("df_id"), F.col("provider")]
    near = ranked(met.select("queries", "vectors").mapInArrow(run, schema), ["query"], best_first, n, "rank")
    return _described(near, catalog).select("query", *ENTITY, "df_description", "score", "rank")


def min_score(hits: DataFrame, threshold: float | Column) -> DataFrame:
    return hits.where(F.col("score") >= threshold)
