"""Time columns of whole cubes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from statcube.functions.timeperiod import parse_time_period, period_end, year_text
from statcube.model import TIME


def with_dates(df: DataFrame, time: str = TIME) -> DataFrame:
    """Period texts become first-day dates; a date column stays as it is."""
    if isinstance(df.schema[time].dataType, T.DateType):
        return df
    return df.withColumn(time, parse_time_period(F.col(time)))


def period_bounds(df: DataFrame, time: str = TIME) -> DataFrame:
    """Add first and last day of the period."""
    return df.withColumns(
        {"period_start": parse_time_period(F.col(time)), "period_end": period_end(F.col(time))}
    )


def year_string(df: DataFrame, time: str = TIME) -> DataFrame:
    """The time column as a four-digit year text."""
    return with_dates(df, time).withColumn(time, year_text(F.col(time)))


def time_range(df: DataFrame, time: str = TIME) -> DataFrame:
    """One row: earliest and latest period of a selection."""
    return df.agg(F.min(time).alias("first_period"), F.max(time).alias("last_period"))


def auto_parse_axis(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_date`` holding dates when any value parses, else only nulls.

    A column cannot change type by its rows in a lazy plan, so ``<column>_is_time``
    says which of the two columns is the axis.
    """
    parsed = parse_time_period(F.col(column))
    any_date = df.agg(F.coalesce(F.max(parsed.isNotNull()), F.lit(False)).alias("any")).scalar()
    return df.withColumns({f"{column}_date": parsed, f"{column}_is_time": any_date})
