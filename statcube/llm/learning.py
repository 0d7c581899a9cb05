"""Bounded labelled samples, and scoring of all rows by array functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

Features = Callable[[str], np.ndarray]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int, features: Features) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and feature arrays of at most ``rows`` labelled documents, in the order of a hash.

    ``usable`` says which labels may be learned from.  The ids are cut to the bound before any text is read;
    only that bounded list is broadcast, and only the features of its documents reach the driver.
    """
    votes = labels.where(usable & F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    picked = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(F.col("label").cast("long"), "doc_id", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [features(t.as_py() or "").tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=["label", "doc_id", "data"])

    found = chosen.mapInArrow(run, "label long, doc_id long, data binary").collect()
    found.sort(key=lambda r: (r["doc_id"], bytes(r["data"])))
    return np.array([r["label"] for r in found], np.float64), [np.frombuffer(r["data"], np.uint64) for r in found]


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def scored(docs: DataFrame, score: Callable[[str], float], held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; a null or empty text is scored as empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [score(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
