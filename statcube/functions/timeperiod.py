"""Period texts (year, semester, quarter, month, week, day) as dates."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The period forms (year, month, quarter, semester, week, day) as one
# pattern, and the first month of quarters and semesters.
PERIOD = r"^\s*[0-9]{4}(-([0-9]{2}|Q[1-4]|S[1-2]|W[0-9]{2}|[0-9]{2}-[0-9]{2}))?\s*$"
FIRST_MONTH = {"-Q1": "-01", "-Q2": "-04", "-Q3": "-07", "-Q4": "-10", "-S1": "-01", "-S2": "-07"}

_BLANKS = " \t\n\r\f\x0b"


def _clean(period: Column) -> Column:
    return F.btrim(period.cast("string"), F.lit(_BLANKS))


def _letter(p: Column) -> Column:
    """Q, S or W of a period; a digit or nothing for the other forms."""
    return F.substring(p, 6, 1)


def parse_time_period(period: Column) -> Column:
    """First day of a period text; null when it is no period or no real date.

    Week n starts 7*(n-1) days after 1 January; these are not ISO weeks.  The optimizer
    copies this expression into filters, so it names its input as rarely as it can.
    """
    text, trimmed = period.cast("string"), _clean(period)
    as_month = text
    for form, month in FIRST_MONTH.items():
        as_month = F.replace(as_month, F.lit(form), F.lit(month))
    first_january = F.concat(F.substring(trimmed, 1, 4), F.lit("-01-01")).try_cast("date")
    week = F.date_add(first_january, (F.substring(trimmed, 7, 2).try_cast("int") - 1) * 7)
    # The cast to date ignores blanks around the text by itself.
    return F.when(
        text.rlike(PERIOD), F.when(text.contains("-W"), week).otherwise(as_month.try_cast("date"))
    )


def period_end(period: Column) -> Column:
    """Last day of a period text."""
    p = _clean(period)
    first = parse_time_period(period)
    months = (
        F.when(F.length(p) == 4, 12).when(_letter(p) == "Q", 3).when(_letter(p) == "S", 6).otherwise(1)
    )
    return (
        F.when(F.length(p) == 10, first)
        .when(_letter(p) == "W", F.date_add(first, 6))
        .otherwise(F.date_sub(F.add_months(first, months), 1))
    )


def is_period(text: str) -> bool:
    """True when a literal has one of the period forms."""
    return re.match(PERIOD, text.strip()) is not None


def year_text(when: Column) -> Column:
    """Four-digit year as text, for discrete axes."""
    return F.date_format(when, "yyyy")
