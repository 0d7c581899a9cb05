"""Whitening of vectors along their leading components, found by spectrum slicing.

Vectors become integers.  The fit list holds each distinct vector once; its sums are exact, its covariance is
summed from centred vectors inside the tasks, and only tables of the size dimension x dimension reach the driver.
There :mod:`statcube.llm.spectrum` finds the leading eigenvectors, and the tasks project every row.

Defined cases: rows whose vector is null or has a null or non-finite component are dropped; missing components of
shorter vectors count as 0; repeated rows are whitened each but counted once in the fit; a row without id stays;
there are as many components as dimensions if these are fewer; a component without variance (up to
rounding) has no whitened value (null) and takes no part in the identity check; ``explained`` is null when no
component varies; a deviation that leaves 64 bits is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from statcube.llm.spectrum import EPS, leading
from statcube.session import scratch_path

OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
# Rows that a task works on at once.
ROWS = 4096


def _integers(rows: DataFrame, scale: int) -> DataFrame:
    finite = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    usable = rows.where(F.col("embedding").isNotNull() & finite)
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: F.floor(c.cast("double") * scale)).alias("x"))


def _blocks(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            some = batch.slice(start, ROWS)
            yield some, some.column("x").flatten().to_numpy().reshape(-1, size)


def _summed(fit: DataFrame, size: int, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of a small table over all vectors: ``of`` gives that of a block of rows."""
    rows, columns = shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for _, x in _blocks(batches, size):
            total += of(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(rows), columns)), pa.array(np.tile(np.arange(columns), rows)), pa.array(total.ravel())], names=["i", "j", "v"])

    table = np.zeros(shape)
    for r in fit.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        table[r["i"], r["j"]] = r["v"]
    return table


def _sums(fit: DataFrame, size: int) -> tuple[int, np.ndarray, int]:
    """Number of vectors, exact sum of each dimension, largest absolute component."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, most = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for _, x in _blocks(batches, size):
            n, total, most = n + len(x), total + x.sum(axis=0), np.maximum(most, np.abs(x).max(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.array(np.full(size, n)), pa.array(total), pa.array(most)], names=["i", "n", "total", "most"])

    parts = fit.mapInArrow(run, "i long, n long, total long, most long").groupBy("i")
    found = parts.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("most")).orderBy("i").collect()
    return found[0]["n"], np.array([r["total"] for r in found]), max(r["most"] for r in found)


def _deviation(x: np.ndarray, n: int, sums: np.ndarray, fits: bool) -> list[int | None]:
    """Sum over the dimensions of (n * x - sum) squared, in integers."""
    if fits:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    wide = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    return [v if v < 2**63 else None for v in wide.tolist()]


def whiten(rows: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """A row per vector of ``rows`` (vec_id, embedding) and leading component.

    Columns: vec_id, component from 1, n (size of the fit list), deviation, whitened, explained (share of all variance)
    and identity_error (how far the covariance of the whitened fit list is from the identity).  Runs jobs when called; the fit
    list is written to the shared folder.
    """
    spark = rows.sparkSession
    integers = _integers(rows, scale)
    size = integers.agg(F.max(F.size("x")).alias("size")).first()["size"]
    if not size:
        return spark.createDataFrame([], OUTPUT)
    padded = integers.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("x"))))
    path = scratch_path(spark, "fit-list")
    padded.select("x").distinct().write.parquet(path)
    fit = spark.read.parquet(path)
    n, sums, most = _sums(fit, size)
    mean = sums / n

    def centred(x: np.ndarray) -> np.ndarray:
        return x - mean

    def products(x: np.ndarray) -> np.ndarray:
        y = centred(x)
        return y.T @ y

    covariance = _summed(fit, size, (size, size), products) / n
    covariance = (covariance + covariance.T) / 2
    k = min(components, size)
    values, vectors = leading(covariance, k)
    trace = float(np.trace(covariance))
    varies = values > size * EPS * max(values[0], 0)
    axes = vectors[varies].T / np.sqrt(values[varies])

    def whitened_products(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ axes
        return w.T @ w

    r = int(varies.sum())
    error = float(np.abs(_summed(fit, size, (r, r), whitened_products) / n - np.eye(r)).max()) if r else 0.0
    explained = [max(float(v), 0.0) / trace if trace > 0 else None for v in values]
    fits = size * (n * int(most) + int(np.abs(sums).max())) ** 2 < 2**63

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches, size):
            m = len(x)
            projected = np.full((m, k), np.nan)
            projected[:, varies] = centred(x) @ axes
            each = np.repeat(np.arange(m), k)
            deviation = pa.array(_deviation(x, n, sums, fits), pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)), deviation.take(pa.array(each)), pa.array(projected.ravel(), from_pandas=True),
                pa.array(explained * m, pa.float64()), pa.array(np.full(m * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return padded.select("vec_id", "x").mapInArrow(run, OUTPUT)
