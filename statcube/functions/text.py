"""Text functions: tokens, titles, prose, territorial codes, links."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Separator of composed titles; territorial code forms, coarse to fine.
TITLE_SEPARATOR = " › "
TERRITORIAL_FORMS = (
    ("nazionale", "^IT$"),
    ("ripartizione", "^IT[A-Z0-9]$"),
    ("regione", "^IT[A-Z0-9]{2}$"),
    ("provincia", "^IT[A-Z0-9]{3}$"),
    ("comune", "^[0-9]{6}$"),
)
# Fixed value: the parameter of a link that holds its id.
LINK_ID = r"[?&]id=(\w+)"
TERRITORIAL_LEVELS = tuple(level for level, _ in TERRITORIAL_FORMS)

WORD = r"([\p{L}\p{N}]+)"


def blank_to_null(text: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def tokenize(text: Column) -> Column:
    """Lower-case runs of letters and digits; an underscore splits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(1))


def compose_title(description: Column, category: Column) -> Column:
    """``category › title`` unless the title already starts with the category."""
    title = F.trim(F.coalesce(description, F.lit("")))
    context = F.trim(F.coalesce(category, F.lit("")))
    return (
        F.when((context == "") | (title == ""), F.concat(title, context))
        .when(F.lower(title).startswith(F.lower(context)), title)
        .otherwise(F.concat(context, F.lit(TITLE_SEPARATOR), title))
    )


def base_code(code: Column) -> Column:
    """Code without its trailing year (and a ``_FROM`` before the year)."""
    return F.regexp_replace(code, "(_FROM)?[0-9]{4}$", "")


def territorial_level(code: Column) -> Column:
    """Territorial level named by the shape of a code; null when none fits."""
    (first, form), *rest = TERRITORIAL_FORMS
    level = F.when(code.rlike(form), first)
    for name, form in rest:
        level = level.when(code.rlike(form), name)
    return level


def link_id(url: Column) -> Column:
    """Value of the ``id`` parameter of a link; null when there is none."""
    return F.nullif(F.regexp_extract(url, LINK_ID, 1), F.lit(""))


def unescape_entities(text: Column) -> Column:
    """HTML character references as characters (no built-in knows the full list)."""

    # Defined here so that it travels by value: executors need not have this package.
    @F.pandas_udf(T.StringType())
    def unescape(batch: pd.Series) -> pd.Series:
        return batch.map(html.unescape, na_action="ignore")

    return unescape(text)


def clean_prose(raw: Column) -> Column:
    """Markup as plain text: entities, then tags, then runs of white space."""
    text = unescape_entities(F.coalesce(raw, F.lit("")))
    text = F.regexp_replace(text, "<[^>]+>", " ")
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def query_parameter(url: Column, name: str) -> Column:
    """Decoded query parameter of a URL; null when absent, empty or malformed."""
    raw = F.try_parse_url(url, F.lit("QUERY"), F.lit(name))
    return F.nullif(F.try_url_decode(raw), F.lit(""))
