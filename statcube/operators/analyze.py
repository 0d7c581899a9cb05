"""Aggregates over cubes: shares, top groups, profiles, wide tables, cube joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from statcube.functions.timeperiod import year_text
from statcube.model import ENTITY, TIME, VALUE


def top_n_groups(df: DataFrame, group: str, n: int, value: str = VALUE) -> DataFrame:
    """Rows of the n groups with the largest sums (ties: smaller group first)."""
    best = (
        df.groupBy(group).agg(F.sum(value).alias("_total"))
        .orderBy(F.col("_total").desc_nulls_last(), group).limit(n).select(group)
    )
    return df.join(best, group, "left_semi")


def category_order(df: DataFrame, category: str, value: str = VALUE) -> DataFrame:
    """Categories by summed value, for the order of bars."""
    return df.groupBy(category).agg(F.sum(value).alias("total")).orderBy("total", category)


def flag_legend(df: DataFrame, flag: str, mark_above: float = 0.1) -> DataFrame:
    """Rows per observation flag, the absent flag included, with share and mark."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.col("n_rows") / total
    return df.groupBy(F.coalesce(flag, F.lit("(absent)")).alias("flag")).agg(
        F.count(F.lit(1)).alias("n_rows")
    ).select("flag", "n_rows", F.round(share, 4).alias("share"), (share > mark_above).alias("is_marked"))


def entity_coverage(df: DataFrame, dim: str, time: str = TIME) -> DataFrame:
    """Per entity: number of periods and the range of years (``time`` is a date)."""
    return df.groupBy(dim).agg(
        F.count_distinct(time).alias("n_periods"),
        year_text(F.min(time)).alias("first_year"), year_text(F.max(time)).alias("last_year"),
    )


def code_frequency(df: DataFrame, dim: str, n: int) -> DataFrame:
    """The n most frequent codes of a dimension."""
    return df.groupBy(dim).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), dim).limit(n)


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, min, max and mean.

    Plain aggregates take one pass.  Exact distinct counts take a second one that
    counts (column, value) pairs, so no row is copied once per column.
    """
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}

    def summary(c: str) -> Column:
        facts = {
            "column_name": F.lit(c),
            "n_rows": F.count(F.lit(1)),
            "n_nulls": F.count_if(F.col(c).isNull()),
            "min_value": F.min(c).cast("string"),
            "max_value": F.max(c).cast("string"),
            "mean": F.round(F.avg(c), 4) if c in numeric else F.lit(None).cast("double"),
        }
        if approximate:
            facts["n_distinct"] = F.approx_count_distinct(c)
        return F.struct(*[v.alias(k) for k, v in facts.items()])

    rows = df.agg(F.array(*[summary(c) for c in df.columns]).alias("_all")).select(F.inline("_all"))
    if approximate:
        return rows
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    pairs = texts.unpivot([], list(df.columns), "column_name", "_value").where("_value IS NOT NULL").distinct()
    distinct = pairs.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    return rows.join(distinct, "column_name", "left").withColumn(
        "n_distinct", F.coalesce("n_distinct", F.lit(0))
    )


def pivot_wide(
    df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str], value: str = VALUE
) -> DataFrame:
    """Long to wide: one column per listed code (cells are unique in a cube)."""
    return df.groupBy(*rows).pivot(column, list(values)).agg(F.max(value))


def annotation_census(annotations: DataFrame) -> DataFrame:
    """Dataflows per annotation type and their share of all annotated dataflows."""
    total = annotations.agg(F.count_distinct("df_id").alias("n")).scalar()
    return annotations.groupBy("annotation_type").agg(F.count_distinct("df_id").alias("n_df")).select(
        "annotation_type", "n_df", F.round(F.col("n_df") / total, 4).alias("share")
    )


def estimate_rows(avail: DataFrame, n_periods: int | Column, keys: Sequence[str] = ENTITY) -> DataFrame:
    """Upper bound of a selection: codes per dimension multiplied, times periods.

    ``varied_dims`` names the dimensions with more than one code.
    """
    counts = avail.select(*keys, "dimension_id", "code_id").distinct().groupBy(*keys, "dimension_id").agg(
        F.count(F.lit(1)).alias("_n")
    )
    return counts.groupBy(*keys).agg(
        (F.product(F.col("_n").cast("double")) * n_periods).alias("max_rows"),
        F.count_if(F.col("_n") > 1).alias("n_varied_dims"),
        F.array_sort(F.collect_list(F.when(F.col("_n") > 1, F.col("dimension_id")))).alias("varied_dims"),
    )


def join_cubes(
    left: DataFrame, right: DataFrame, keys: Sequence[str], derived: Mapping[str, Column]
) -> DataFrame:
    """Join two cubes on shared dimensions and add derived columns."""
    joined = left.join(right, list(keys))
    return reduce(lambda df, item: df.withColumn(*item), derived.items(), joined)
