"""Which codes really occur."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from statcube.operators.series import ranked


def available_codes(df: DataFrame, dims: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Distinct codes per dimension (and per ``keys``, e.g. the dataflow)."""
    as_text = df.select(*keys, *[F.col(d).cast("string").alias(d) for d in dims])
    return (
        as_text.unpivot(list(keys), list(dims), "dimension_id", "code_id")
        .where(F.col("code_id").isNotNull())
        .distinct()
    )


def constraint_summary(dims: DataFrame, avail: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per dimension of the structure: number of codes, three of them, source.

    Only three codes per dimension are ever gathered into one row.
    """
    group = [*keys, "dimension_id"]
    codes = avail.select(*group, "code_id").distinct()
    counts = codes.groupBy(*group).agg(F.count(F.lit(1)).alias("n_values"))
    sample = ranked(codes, group, [F.col("code_id").asc()], 3).groupBy(*group).agg(
        F.array_join(F.array_sort(F.collect_list("code_id")), ", ").alias("sample")
    )
    return (
        dims.join(counts, group, "left").join(sample, group, "left")
        .select(
            *dims.columns, "n_values", F.coalesce("sample", F.lit("")).alias("sample"),
            F.when(F.col("n_values").isNull(), "missing").otherwise("constraint").alias("source"),
        )
    )
