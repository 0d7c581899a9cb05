"""Release calendars in iCal text as event rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the format: the start of an event, "NAME;parameters:value" lines, dates of eight digits.
BLOCK = "BEGIN:VEVENT"
DAY = r"^(\d{4})(\d{2})(\d{2})$"


def _field(name: str) -> Column:
    return F.trim(F.regexp_extract("_block", f"(?m)^{name}[^:]*:(.+)$", 1))


def flatten_calendar(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per event; eight digits become an ISO date, categories an array."""
    blocks = df.select(*keep, F.explode(F.slice(F.split(column, BLOCK), 2, 2**31 - 1)).alias("_block"))
    return blocks.select(
        *keep, _field("UID").alias("uid"), _field("SUMMARY").alias("summary"),
        F.regexp_replace(_field("DTSTART"), DAY, "$1-$2-$3").alias("date"),
        _field("X-THEME").alias("theme"),
        F.transform(F.split(_field("X-CATEGORY"), r"\\,"), lambda c: F.trim(c)).alias("categories"),
    )
