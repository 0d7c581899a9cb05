"""Operators per series, a series being the rows that share all dimensions but time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from statcube.model import TIME

# Up to this n the engine itself keeps n rows per key and task before the shuffle.
PRUNED_BEFORE_SHUFFLE = 1000
SALTS = 64


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "_rank") -> DataFrame:
    """The first n rows of every key, with their rank.

    Small n needs no care: rows beyond n are dropped in the map tasks.  A large n on
    a hot key is first cut within salted parts of the key, so no task sorts it whole.
    """
    if n < 1:
        raise ValueError("n must be positive")
    if n > PRUNED_BEFORE_SHUFFLE:
        part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(SALTS))
        salted = W.partitionBy(*keys, "_salt").orderBy(*order)
        df = df.withColumn("_salt", part).withColumn("_cut", F.row_number().over(salted))
        df = df.where(F.col("_cut") <= n).drop("_salt", "_cut")
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def _orders(df: DataFrame, dims: Sequence[str], time: str) -> tuple[list[Column], list[Column]]:
    """Ascending and exactly mirrored total order inside a series."""
    columns = [time, *[c for c in df.columns if c not in dims and c != time]]
    return (
        [F.col(c).asc_nulls_first() for c in columns],
        [F.col(c).desc_nulls_last() for c in columns],
    )


def first_n(df: DataFrame, dims: Sequence[str], n: int, time: str = TIME) -> DataFrame:
    return ranked(df, dims, _orders(df, dims, time)[0], n).drop("_rank")


def last_n(df: DataFrame, dims: Sequence[str], n: int, time: str = TIME) -> DataFrame:
    return ranked(df, dims, _orders(df, dims, time)[1], n).drop("_rank")


def first_and_last_n(df: DataFrame, dims: Sequence[str], first: int, last: int, time: str = TIME) -> DataFrame:
    """Union of both ends; rows of a short series appear once.

    The row with rank r from the end is row ``size - r + 1`` from the start, so the
    overlap is cut by the series size and no series is ever sorted whole.
    """
    ascending, descending = _orders(df, dims, time)
    head = ranked(df, dims, ascending, first).drop("_rank")
    tail = ranked(df, dims, descending, last, "_from_end")
    sizes = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("_size"))
    same_series = [tail[d].eqNullSafe(sizes[d]) for d in dims]
    beyond = (
        tail.join(sizes, same_series)
        .where(F.col("_size") - F.col("_from_end") + 1 > first)
        .select(*[tail[c] for c in df.columns])
    )
    return head.unionByName(beyond)


def series_count(df: DataFrame, dims: Sequence[str], warn_above: int = 5000) -> DataFrame:
    """One row: number of series and whether an unlimited read deserves a warning."""
    count = F.count(F.lit(1))
    return df.select(*dims).distinct().agg(
        count.alias("n_series"), (count > warn_above).alias("is_large")
    )


def latest_period(df: DataFrame, time: str = TIME) -> DataFrame:
    """Rows of the latest period of the whole frame."""
    return df.where(F.col(time) == df.agg(F.max(time)).scalar())


def latest_per_entity(df: DataFrame, entity: Sequence[str], time: str = TIME) -> DataFrame:
    """The most recent row of every entity."""
    return last_n(df, entity, 1, time)


def sort_by_time(df: DataFrame, time: str = TIME) -> DataFrame:
    """By period; ties by the other columns, so that one period with most rows still spreads over tasks."""
    ties = [f.name for f in df.schema if f.name != time and isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    return df.orderBy(F.col(time).asc_nulls_first(), *ties)
