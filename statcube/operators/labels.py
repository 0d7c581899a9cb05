"""Human-readable names for codes, and membership of codes in a dataflow."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from statcube.model import ENTITY, check_entity, codes_of
from statcube.session import BROADCAST_BYTES, cut_lineage


def folded(column: str | Column) -> Column:
    """Dimension name without case, dash as underscore."""
    c = F.col(column) if isinstance(column, str) else column
    return F.replace(F.upper(c), F.lit("-"), F.lit("_"))


def _last_names(codelists: DataFrame, lang: str | None) -> DataFrame:
    """(codelist_id, id, name), one row per code: the last listed name stays."""
    chosen = codelists if lang is None else codelists.where(F.col("lang") == lang)
    listed = [c for c in ("seq", "order") if c in codelists.columns]
    return chosen.where("id IS NOT NULL").groupBy("codelist_id", "id").agg(
        F.max_by("name", F.struct(*[F.coalesce(F.col(c), F.lit(-1)) for c in listed], "name")).alias("name")
    )


def codelist_names(codelists: DataFrame, codelist_id: str, lang: str | None = None) -> DataFrame:
    """(id, name) of one codelist, one row per code: the last listed name stays."""
    return _last_names(codelists.where(F.col("codelist_id") == codelist_id), lang).select("id", "name")


def enrich_labels(
    df: DataFrame, dims: Mapping[str, str | None], codelists: DataFrame, lang: str | None = None
) -> DataFrame:
    """Add ``<column>_label`` for every dimension that has a codelist.

    ``dims`` maps dimension ids to codelist ids.  Codes and rows stay; a code
    without a name gets a null label.  The table of codelists is read once: the names of all needed lists are
    checkpointed and measured, and lists that fit together into the broadcast limit reach the rows where
    they are.  Only a longer list is joined by a shuffle, which AQE splits where a code is hot.  Runs jobs when called.
    """
    by_upper = {c.upper(): c for c in df.columns}
    wanted = {by_upper[dim.upper()]: codelist for dim, codelist in dims.items() if codelist and dim.upper() in by_upper}
    if not wanted:
        return df
    needed = codelists.where(F.col("codelist_id").isin(sorted(set(wanted.values()))))
    names = cut_lineage(_last_names(needed, lang))
    width = F.octet_length("id") + F.coalesce(F.octet_length("name"), F.lit(0)) + 64
    sizes = {r["codelist_id"]: r["bytes"] for r in names.groupBy("codelist_id").agg(F.sum(width).alias("bytes")).collect()}
    left = BROADCAST_BYTES
    for column, codelist in sorted(wanted.items(), key=lambda item: (sizes.get(item[1], 0), list(wanted).index(item[0]))):
        own = names.where(F.col("codelist_id") == codelist).select(
            F.col("id").alias("_code"), F.col("name").alias(f"{column}_label")
        )
        left -= sizes.get(codelist, 0)
        joined = F.broadcast(own) if left >= 0 else own
        df = df.join(joined, F.col(column) == F.col("_code"), "left").drop("_code")
    labels = {f"{column}_label" for column in wanted}
    return df.select(*[c for c in df.columns if c not in labels], *[f"{column}_label" for column in wanted])


def describe_filters(
    spark, filters: Mapping[str, object], dims: Mapping[str, str | None],
    codelists: DataFrame, lang: str | None = None,
) -> DataFrame:
    """(dimension_id, value, description) of the active filters of a query.

    A value of several codes, or one the codelist lacks, has an empty description.
    """
    active = [
        (dim, value if isinstance(value, str) else "+".join(codes_of(value)), dims.get(dim))
        for dim, value in filters.items() if codes_of(value)
    ]
    spec = spark.createDataFrame(active, "dimension_id string, value string, codelist_id string")
    wanted = codelists.where(F.col("lang") == lang) if lang is not None else codelists
    names = (
        wanted.join(
            spec.select("codelist_id", F.col("value").alias("id")).distinct(), ["codelist_id", "id"], "left_semi"
        )
        .groupBy("codelist_id", F.col("id").alias("value"))
        .agg(F.max("name").alias("name"))
    )
    return spec.join(names, ["codelist_id", "value"], "left").select(
        "dimension_id", "value", F.coalesce("name", F.lit("")).alias("description")
    )


def of_dataflow(avail: DataFrame, provider: str | None = None, df_id: str | None = None) -> DataFrame:
    """The rows of one dataflow out of a table of many; of all its dataflows when none is named."""
    check_entity(avail)
    if (provider is None) != (df_id is None):
        raise ValueError("a dataflow is known by provider and id")
    if provider is None:
        return avail
    return avail.where((F.col("provider") == provider) & (F.col("df_id") == df_id))


def constraint_labels(avail: DataFrame, names: DataFrame, dimension: str, provider: str, df_id: str) -> DataFrame:
    """Codes of one dimension that occur in a dataflow, with their names ("" when unknown)."""
    codes = of_dataflow(avail, provider, df_id).where(folded("dimension_id") == folded(F.lit(dimension)))
    codes = codes.select(F.col("code_id").alias("id")).distinct()
    return codes.join(names.select("id", "name"), "id", "left").select(
        "id", F.coalesce("name", F.lit("")).alias("name")
    )


def values_in_dataflow(
    names: DataFrame, avail: DataFrame, dimension: str, provider: str | None = None, df_id: str | None = None
) -> DataFrame:
    """Whole codelist with ``in_dataflow``: whether the dataflow, or any when none is named, has the code.

    Without any availability row for the dimension membership is unknown, so the
    flag is null, not false.
    """
    codes = of_dataflow(avail, provider, df_id).where(folded("dimension_id") == folded(F.lit(dimension)))
    known = codes.agg((F.count(F.lit(1)) > 0).alias("known")).scalar()
    present = codes.select(F.col("code_id").alias("id")).distinct().withColumn("_hit", F.lit(True))
    return names.join(present, "id", "left").withColumn(
        "in_dataflow", F.when(known, F.coalesce("_hit", F.lit(False)))
    ).drop("_hit")


def membership_counts(values: DataFrame) -> DataFrame:
    """Size of the codelist and how many of its codes the dataflow has."""
    return values.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.coalesce(F.sum(F.col("in_dataflow").cast("long")), F.lit(0)).alias("n_present"),
    )


def metadata_companion(
    avail: DataFrame, dims: DataFrame, codelists: DataFrame, keys: Sequence[str] = ENTITY
) -> DataFrame:
    """(dimension, code, label) of every dimension with more than one value."""
    codes = avail.select(*keys, "dimension_id", "code_id").distinct()
    varied = (
        codes.groupBy(*keys, "dimension_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    )
    names = codelists.groupBy("codelist_id", F.col("id").alias("code_id")).agg(F.max("name").alias("label"))
    return (
        codes.join(varied, [*keys, "dimension_id"], "left_semi")
        .join(dims.select("dimension_id", "codelist_id"), "dimension_id", "left")
        .join(names, ["codelist_id", "code_id"], "left")
        .select(*keys, F.col("dimension_id").alias("dimension"), F.col("code_id").alias("code"), "label")
    )


def label_join_replace(df: DataFrame, column: str, names: DataFrame, name: str) -> DataFrame:
    """Replace a code column by its name; rows without a name are dropped."""
    pairs = names.select(F.col("id").alias("_code"), F.col("name").alias("_name"))
    kept = [F.col("_name").alias(name) if c == column else F.col(c) for c in df.columns]
    return df.join(pairs, F.col(column) == F.col("_code")).select(*kept)


def dimensions_info(catalog: DataFrame, dims: DataFrame, codelist_info: DataFrame) -> DataFrame:
    """Dimensions of every dataflow with a description.

    A dataflow without a structure id uses its own id; a dimension's own label wins
    over the description of its codelist.
    """
    check_entity(catalog)
    structures = catalog.select(*ENTITY, F.coalesce("df_structure_id", "df_id").alias("structure_id"))
    own = F.col("label") if "label" in dims.columns else F.lit(None).cast("string")
    info = codelist_info.select("codelist_id", F.col("description").alias("_info"))
    described = dims.join(info, "codelist_id", "left").select(
        "structure_id", "dimension_id", "position", "codelist_id",
        F.coalesce(F.nullif(own, F.lit("")), "_info").alias("description"),
    )
    return structures.join(described, "structure_id").select(
        *ENTITY, "dimension_id", "position", "codelist_id", "description"
    )


def dimension_values(
    dims: DataFrame, codelists: DataFrame, structure_id: str, dimension: str, lang: str
) -> DataFrame:
    """(id, name) of the codelist of one dimension in one language."""
    wanted = dims.where(
        (F.col("structure_id") == structure_id) & (F.upper("dimension_id") == dimension.upper())
    ).select("codelist_id").distinct()
    return codelists.where(F.col("lang") == lang).join(wanted, "codelist_id", "left_semi").select("id", "name")
