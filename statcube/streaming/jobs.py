"""Streams over landing folders: codes that occur, and upserts by key.

Both are for ``trigger(availableNow=True)`` runs as well as for continuous ones, and a
replayed batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from statcube.operators.codes import available_codes
from statcube.operators.series import ranked

BATCH = "batch"
COMPACTED = -1


def stream_available_codes(
    observations: DataFrame, dims: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """New (dimension, code) pairs of a stream of observations.

    State is one key per code.  Codes never expire, hence no watermark.
    """
    return available_codes(observations, dims, keys)


def start_codes_archive(codes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append new codes to a Parquet archive until the input is used up."""
    return (
        codes.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )


def stream_upsert(rows: DataFrame, keys: Sequence[str], path: str, checkpoint: str, stamp: str) -> StreamingQuery:
    """Upsert a stream into a table folder.

    Each batch, reduced to its newest row per key, becomes one ``batch=`` folder; a
    replay overwrites its own folder.  The table is not rewritten per batch:
    :func:`read_upserted` takes the newest row per key, :func:`compact_upserted`
    folds the batches together now and then.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        newest = _newest(batch, keys, [F.col(stamp).desc_nulls_last()])
        newest.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")

    return (
        rows.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _newest(df: DataFrame, keys: Sequence[str], order: list) -> DataFrame:
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    return ranked(df, keys, [*order, *rest], 1).drop("_rank")


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str], stamp: str) -> DataFrame:
    """The table behind the batches: newest row per key, later batch on a tie."""
    log = spark.read.parquet(path)
    return _newest(log, keys, [F.col(stamp).desc_nulls_last(), F.desc(BATCH)]).drop(BATCH)


def compact_upserted(spark: SparkSession, path: str, target: str, keys: Sequence[str], stamp: str) -> None:
    """Write the current table as a single batch of a fresh folder.

    Its number is below that of any stream's batch: a stream that goes on in that folder
    never overwrites it, and wins ties against it.
    """
    table = read_upserted(spark, path, keys, stamp)
    table.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{BATCH}={COMPACTED}")
