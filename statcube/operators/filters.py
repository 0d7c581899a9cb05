"""Filters and projections on cubes, catalogs and code tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from statcube.functions.timeperiod import is_period, parse_time_period, period_end, year_text
from statcube.model import ENTITY, TIME, VALUE, Filters, bind_dims, check_entity, filters_of_key

# Code lists up to this length travel inside the plan (and reach the scan as an IN
# filter); longer ones become a table and a semi join.
INLINE_CODES = 1000


def filter_dims(df: DataFrame, filters: Filters, dims: Sequence[str] | None = None) -> DataFrame:
    """Keep rows whose code is in the chosen set of every filtered dimension."""
    columns = list(dims) if dims is not None else [c for c in df.columns if c not in (TIME, VALUE)]
    for column, codes in bind_dims(columns, filters).items():
        if not codes:
            continue
        if len(codes) <= INLINE_CODES:
            df = df.where(F.col(column).isin(codes))
        else:
            chosen = df.sparkSession.createDataFrame([(c,) for c in codes], f"`{column}` string")
            df = df.join(chosen, column, "left_semi").select(*df.columns)
    return df


def filter_key(df: DataFrame, key: str, dims: Sequence[str]) -> DataFrame:
    """Keep rows matching a positional key such as ``A..IT+DE``."""
    return filter_dims(df, filters_of_key(key, dims), dims)


def filter_period(
    df: DataFrame, start: str | None = None, end: str | None = None, time: str = TIME
) -> DataFrame:
    """Keep observations whose first day lies in the window, both ends included.

    The bounds are period texts; a cube stored with a date column gets plain date
    comparisons that reach the file scan.
    """
    for bound in (start, end):
        if bound and not is_period(bound):
            raise ValueError(f"not a period: {bound!r}")
    stored_as_date = isinstance(df.schema[time].dataType, T.DateType)
    when = F.col(time) if stored_as_date else parse_time_period(F.col(time))
    first, last = parse_time_period(F.lit(start)), period_end(F.lit(end))
    if start and end and not stored_as_date:
        # 0 <= days <= span, written so that the text is parsed once per row.
        span = F.datediff(last, first)
        return df.where(F.abs(2 * F.datediff(when, first) - span) <= span)
    if start:
        df = df.where(when >= first)
    if end:
        df = df.where(when <= last)
    return df


def filter_period_year(
    df: DataFrame, start: str | None = None, end: str | None = None, time: str = TIME
) -> DataFrame:
    """Window on the first four characters, for sources whose periods are years."""
    year = F.substring(F.col(time), 1, 4)
    if start:
        df = df.where(year >= str(start)[:4])
    if end:
        df = df.where(year <= str(end)[:4])
    return df


def grep(df: DataFrame, pattern: str, columns: Sequence[str]) -> DataFrame:
    """Keep rows where a case-insensitive regular expression is found in any column."""
    try:
        re.compile(pattern)
    except re.error as problem:
        raise ValueError(f"bad pattern {pattern!r}: {problem}") from None
    found = [F.coalesce(F.col(c).cast("string"), F.lit("")).rlike(f"(?iu){pattern}") for c in columns]
    return df.where(reduce(Column.__or__, found))


def exclude_blacklisted(catalog: DataFrame, blacklist: DataFrame) -> DataFrame:
    check_entity(catalog, blacklist)
    return catalog.join(blacklist.select(*ENTITY), [*ENTITY], "left_anti")


def conform_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Add the expected columns that are missing, as typed nulls."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in expected if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def _oldest(df: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(stamp).alias("_oldest"))


def _young_keys(ages: DataFrame, keys: Sequence[str], ttl_seconds: int, now: str, strict: bool) -> DataFrame:
    oldest = F.col("_oldest").cast("timestamp").cast("double")
    age = F.lit(now).cast("timestamp").cast("double") - oldest
    return ages.where(age < ttl_seconds if strict else age <= ttl_seconds).select(*keys)


def fresh_only(
    df: DataFrame, keys: Sequence[str], ttl_seconds: int, now: str,
    stamp: str = "cached_at", strict: bool = False,
) -> DataFrame:
    """Keep groups whose oldest row is within the time to live."""
    young = _young_keys(_oldest(df, keys, stamp), keys, ttl_seconds, now, strict)
    return df.join(young, list(keys), "left_semi")


def fresh_pair(
    first: DataFrame, second: DataFrame, keys: Sequence[str], ttl_seconds: int, now: str,
    stamp: str = "cached_at", strict: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Two tables kept together: a group present in both, aged by its older member."""
    both = _oldest(first, keys, stamp).join(
        _oldest(second, keys, stamp).withColumnRenamed("_oldest", "_other"), list(keys)
    ).withColumn("_oldest", F.least("_oldest", "_other"))
    young = _young_keys(both, keys, ttl_seconds, now, strict)
    return first.join(young, list(keys), "left_semi"), second.join(young, list(keys), "left_semi")


def exclude_aggregates(df: DataFrame, totals: Mapping[str, Sequence[str]] | DataFrame) -> DataFrame:
    """Drop rows carrying a total or sub-total code.

    ``totals`` is a mapping of short code lists, or a (dimension_id, code_id) table.
    A null code is no total: both forms keep such rows.
    """
    if isinstance(totals, Mapping):
        for dim, codes in totals.items():
            df = df.where(~F.coalesce(F.col(dim).isin(list(codes)), F.lit(False)))
        return df
    for dim in [c for c in df.columns if c not in (TIME, VALUE)]:
        codes = totals.where(F.col("dimension_id") == dim).select(F.col("code_id").alias(dim))
        df = df.join(codes, dim, "left_anti").select(*df.columns)
    return df


def split_unit(df: DataFrame, unit: str, column: str = "UNIT", time: str = TIME) -> DataFrame:
    """Rows of one unit of measure, with the year as text."""
    return df.where(F.col(column) == unit).withColumn("year", year_text(F.col(time)))


def search_page_projection(hits: DataFrame) -> DataFrame:
    """Columns of a result page; the category is always there, even without a tree."""
    category = F.col("cat_primary") if "cat_primary" in hits.columns else F.lit(None).cast("string")
    check_entity(hits)
    return hits.select(
        *ENTITY,
        F.coalesce("df_description", F.lit("")).alias("df_description"),
        F.coalesce(category, F.lit("")).alias("category"),
        F.round(F.col("score").cast("double"), 2).alias("score"),
    )


def group_key(df: DataFrame, columns: Sequence[str], name: str = "group_key") -> DataFrame:
    """Two or more columns joined by ``_`` into one grouping column (null if any is null)."""
    parts = [p for c in columns for p in (F.lit("_"), F.col(c).cast("string"))][1:]
    return df.withColumn(name, F.concat(*parts))


def relabel(df: DataFrame, column: str, short: Mapping[str, str]) -> DataFrame:
    """Replace the listed long labels, keep the others."""
    label = F.col(column)
    chain = reduce(lambda c, kv: c.when(label == kv[0], kv[1]), short.items(), F.when(F.lit(False), label))
    return df.withColumn(column, chain.otherwise(label))
