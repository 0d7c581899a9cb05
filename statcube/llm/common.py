"""Column expressions and reading shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# White space of the contracts: space and the controls 9 to 13.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; a null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Words in order, unchanged: maximal runs of characters that are no white space."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def word_count(text: Column) -> Column:
    """Number of words, without building them one by one."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def count_of(text: Column, characters: str) -> Column:
    """Occurrences of single characters, one plain search for each."""
    n = F.lit(0)
    for c in characters:
        n = n + F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    return n


def char_count(text: Column, pattern: str) -> Column:
    """Number of code points that match a character class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def fraction_of(column: Column, salt: str) -> Column:
    """A reproducible fraction in [0, 1) of a key, also computable in plain SQL (32 bits of md5)."""
    digest = F.md5(F.concat(F.coalesce(column.cast("string"), F.lit("")), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % parts
