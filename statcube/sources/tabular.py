"""CSV, TSV, NDJSON and Parquet files."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, functions as F

from statcube.model import VALUE
from statcube.operators.archive import ARCHIVE_ORDER

SUPPRESSED = "_"
_CSV = {"header": "true", "inferSchema": "false", "escape": '"'}


def _csv_options(multi_line: bool, separator: str = ",") -> dict[str, str]:
    return {**_CSV, "multiLine": str(multi_line).lower(), "sep": separator}


def suffix_of(path: str) -> str:
    return PurePosixPath(path).suffix.lower()


def read_observations(
    spark: SparkSession, path: str, null_marker: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Observation CSV: every column text, the value a double (null when no number).

    Files are split over tasks.  ``multi_line`` is for line breaks inside quotes; a file
    is then one task.
    """
    options = _csv_options(multi_line)
    if null_marker is not None:
        options["nullValue"] = null_marker
    rows = spark.read.options(**options).csv(path)
    if VALUE not in rows.columns:
        return rows
    return rows.withColumn(VALUE, F.col(VALUE).try_cast("double"))


def read_suppressed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Observation CSV in which ``_`` marks a suppressed cell, in any column."""
    return read_observations(spark, path, null_marker=SUPPRESSED)


def value_failures(raw: DataFrame, value: str = VALUE) -> DataFrame:
    """One row: how many value texts are no number (they become null)."""
    bad = F.col(value).isNotNull() & F.col(value).try_cast("double").isNull()
    return raw.agg(F.count_if(bad).alias("n_bad_values"))


def read_local(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """csv, tsv or parquet by suffix; text columns stay text."""
    suffix = suffix_of(path)
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix in (".csv", ".tsv"):
        return spark.read.options(**_csv_options(multi_line, "\t" if suffix == ".tsv" else ",")).csv(path)
    raise ValueError(f"cannot read {suffix!r}: use .csv, .tsv or .parquet")


def write_output(df: DataFrame, path: str) -> None:
    """csv, parquet or json (one object per line) by suffix, as a folder of parts."""
    suffix = suffix_of(path)
    writer = df.write.mode("overwrite")
    if suffix == ".parquet":
        writer.parquet(path)
    elif suffix == ".json":
        writer.option("ignoreNullFields", "false").json(path)
    elif suffix == ".csv":
        writer.options(header="true", escape='"').csv(path)
    else:
        raise ValueError(f"cannot write {suffix!r}: use .csv, .parquet or .json")


def write_archive(archive: DataFrame, path: str, partition: str | None = None) -> None:
    """Archive sorted by its key, replaced as a whole or per partition value.

    Range partitioning spreads a hot dataflow over tasks, because codes are in the key.
    """
    keys = list(dict.fromkeys([*([partition] if partition else []), *ARCHIVE_ORDER]))
    writer = archive.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite")
    if partition:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition)
    writer.parquet(path)
