"""Catalog, category links and availability: joins and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from statcube.model import ENTITY, check_entity, codes_of
from statcube.operators.labels import folded, of_dataflow

LEAF = ["scheme_id", "cat_path"]


def with_category_context(catalog: DataFrame, context: DataFrame) -> DataFrame:
    """Attach category names; a dataflow without category gets an empty context."""
    check_entity(catalog, context)
    return catalog.join(context, [*ENTITY], "left").withColumn(
        "cat_context", F.coalesce("cat_context", F.lit(""))
    )


def category_token(token: str) -> Column:
    """True for the exact path or a path ending in the token."""
    return (F.col("cat_path") == token) | F.col("cat_path").endswith(f".{token}")


def filter_by_category(catalog: DataFrame, links: DataFrame, token: str) -> DataFrame:
    """Dataflows of a category, one row per membership."""
    check_entity(catalog, links)
    return catalog.join(links.where(category_token(token)), [*ENTITY])


def restrict_to_category(results: DataFrame, links: DataFrame, token: str) -> DataFrame:
    """Results that belong to a category, never multiplied."""
    check_entity(results, links)
    return results.join(links.where(category_token(token)).select(*ENTITY), [*ENTITY], "left_semi")


def category_names(categories: DataFrame) -> DataFrame:
    """One row per category: the names of its scheme and itself."""
    return categories.groupBy(*LEAF).agg(F.max("scheme_name").alias("scheme_name"), F.max("cat_name").alias("cat_name"))


def siblings(provider: str, df_id: str, links: DataFrame, categories: DataFrame, catalog: DataFrame) -> DataFrame:
    """All dataflows of the provider that share a category with the given one, per category."""
    check_entity(links, catalog)
    is_target = F.upper("df_id") == df_id.upper()
    mine = links.where(F.col("provider") == provider)
    memberships = mine.where(is_target).select(*LEAF).distinct()
    shared = mine.select(*ENTITY, *LEAF).join(memberships, LEAF, "left_semi").distinct()
    return (
        shared.join(category_names(categories), LEAF, "left")
        .join(catalog.select(*ENTITY, "df_description"), [*ENTITY], "left")
        .select(
            "scheme_id", F.coalesce("scheme_name", F.lit("")).alias("scheme_name"),
            "cat_path", F.coalesce("cat_name", F.lit("")).alias("cat_name"), *ENTITY,
            F.coalesce("df_description", F.lit("")).alias("df_description"),
            is_target.alias("is_target"),
        )
    )


def category_dataflows(links: DataFrame, rendered: DataFrame, catalog: DataFrame) -> DataFrame:
    """Dataflows hanging below the shown categories, by category then title."""
    check_entity(links, catalog)
    leaves = links.join(rendered.select(*LEAF).distinct(), LEAF, "left_semi")
    described = leaves.join(catalog.select(*ENTITY, "df_description"), [*ENTITY], "left").select(
        *LEAF, *ENTITY, F.coalesce("df_description", F.lit("")).alias("df_description")
    )
    title = F.when(F.col("df_description") != "", F.col("df_description")).otherwise(F.col("df_id"))
    return described.orderBy(*LEAF, title, "df_id", "provider")


def invalid_codes(
    spark, filters: Mapping[str, object], avail: DataFrame, provider: str | None = None, df_id: str | None = None
) -> DataFrame:
    """Requested codes that do not occur in a dataflow, or in any when none is named.

    Dimensions without availability are not judged.
    The short request side is joined to the table first, so only matching keys move.
    """
    wanted = spark.createDataFrame(
        [(dim, code) for dim, value in filters.items() for code in codes_of(value)],
        "dimension_id string, code_id string",
    ).withColumn("_dim", folded("dimension_id"))
    codes = of_dataflow(avail, provider, df_id).select(folded("dimension_id").alias("_dim"), "code_id")
    known = codes.join(wanted.select("_dim").distinct(), "_dim", "left_semi").select("_dim").distinct()
    present = codes.join(wanted.select("_dim", "code_id"), ["_dim", "code_id"], "left_semi").distinct()
    return (
        wanted.join(known, "_dim", "left_semi")
        .join(present, ["_dim", "code_id"], "left_anti")
        .select("dimension_id", "code_id")
    )


def match_catalog_ids(long_ids: DataFrame, catalog: DataFrame) -> DataFrame:
    """Map long dataflow ids (provider, long_id) to ids of that provider: itself, else the part before ``_DF_``."""
    check_entity(catalog)
    known = catalog.select(*ENTITY).distinct()
    direct = known.select("provider", F.col("df_id").alias("long_id"), F.col("df_id").alias("_direct"))
    short = known.select("provider", F.col("df_id").alias("_before"), F.col("df_id").alias("_short"))
    before = F.when(F.col("long_id").contains("_DF_"), F.substring_index("long_id", "_DF_", 1))
    return (
        long_ids.join(direct, ["provider", "long_id"], "left")
        .withColumn("_before", before).join(short, ["provider", "_before"], "left")
        .withColumn("catalog_id", F.coalesce("_direct", "_short"))
        .select(*long_ids.columns, "catalog_id")
    )


def has_constraint_flag(catalog: DataFrame, matched: DataFrame, bulk_succeeded: bool) -> DataFrame:
    """True where matched; false where not, or null when the bulk load failed."""
    check_entity(catalog)
    hit = matched.where(F.col("catalog_id").isNotNull()).select("provider", F.col("catalog_id").alias("df_id")).distinct()
    missing = F.lit(False) if bulk_succeeded else F.lit(None).cast("boolean")
    return (
        catalog.drop("has_constraint")
        .join(hit.withColumn("_hit", F.lit(True)), [*ENTITY], "left")
        .withColumn("has_constraint", F.coalesce("_hit", missing))
        .drop("_hit")
    )


def resolve_dataflows(identifiers: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog id of every (provider, identifier): by id, else structure id, else exact title, of that provider.

    The catalog is read once: each dataflow offers its three names as rows, and the identifiers ask by the same
    three. Every name keeps its smallest id by a combinable aggregate, so a structure shared by very many dataflows
    costs one row.
    """
    check_entity(catalog)
    asked = identifiers.select("provider", "identifier").distinct()

    def ways(*names: Column) -> Column:
        return F.inline(F.array(*[F.struct(F.lit(i).alias("tier"), c.alias("name")) for i, c in enumerate(names)]))

    offered = catalog.select(*ENTITY, ways(F.upper("df_id"), F.upper("df_structure_id"), F.col("df_description")))
    wanted = asked.select("provider", "identifier", ways(F.upper("identifier"), F.upper("identifier"), F.col("identifier")))
    keys = ["provider", "tier", "name"]
    best = (
        offered.join(wanted.select(*keys).distinct(), keys, "left_semi").groupBy(*keys).agg(F.min("df_id").alias("df_id"))
    )
    found = wanted.join(best, keys).groupBy("provider", "identifier").agg(F.min(F.struct("tier", "df_id")).alias("_best"))
    return asked.join(found, ["provider", "identifier"], "left").select("provider", "identifier", F.col("_best.df_id").alias("df_id"))


def stale_links(links: DataFrame, catalog: DataFrame) -> DataFrame:
    """Category links whose dataflow left the catalog."""
    check_entity(links, catalog)
    return links.join(catalog.select(*ENTITY), [*ENTITY], "left_anti").select(*links.columns)


def stale_link_counts(links: DataFrame, catalog: DataFrame) -> DataFrame:
    """Number of stale links and of all links."""
    check_entity(links, catalog)
    known = catalog.select(*ENTITY).distinct().withColumn("_known", F.lit(True))
    return links.join(known, [*ENTITY], "left").agg(
        F.count_if(F.col("_known").isNull()).alias("n_stale"), F.count(F.lit(1)).alias("n_links")
    )


def category_context(links: DataFrame, categories: DataFrame, include_scheme: bool = True) -> DataFrame:
    """Per dataflow: its category names in the order of the paths, and the alphabetically first one.

    The group is the categories of one dataflow; its text is the result itself.
    """
    check_entity(links)
    named = links.join(category_names(categories), LEAF, "left")
    own = F.trim(F.coalesce("cat_name", F.lit("")))
    shown = F.trim(F.concat(F.coalesce("scheme_name", F.lit("")), F.lit(" "), F.coalesce("cat_name", F.lit("")))) if include_scheme else own
    entry = F.struct(*LEAF, shown.alias("shown"))
    grouped = named.groupBy(*ENTITY).agg(F.array_sort(F.collect_list(entry)).alias("_entries"), F.min(own).alias("cat_primary"))
    return grouped.select(*ENTITY, F.array_join("_entries.shown", " ").alias("cat_context"), "cat_primary")


def dataflow_counts(links: DataFrame) -> DataFrame:
    """Distinct dataflows per category, direct members only."""
    check_entity(links)
    return links.groupBy(*LEAF).agg(F.count_distinct(*ENTITY).alias("n_df"))


def scheme_counts(links: DataFrame) -> DataFrame:
    check_entity(links)
    return links.groupBy("scheme_id").agg(F.count_distinct(*ENTITY).alias("n_df"))


def catalog_coverage(catalog: DataFrame, links: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of catalog dataflows having a category, 0-100; null for an empty catalog."""
    check_entity(catalog, links)
    group = list(dict.fromkeys([*by, *ENTITY]))
    known = catalog.select(*group).distinct()
    linked = links.select(*ENTITY).distinct().withColumn("_linked", F.lit(True))
    total, hits = F.count(F.lit(1)), F.count_if(F.col("_linked").isNotNull())
    share = F.when(total > 0, 100.0 * hits / F.nullif(total, F.lit(0)))
    return known.join(linked, [*ENTITY], "left").groupBy(*by).agg(
        total.alias("n_total"), hits.alias("n_categorised"),
        share.alias("coverage"), F.floor(share).alias("coverage_shown"),
    )


def provider_overview(providers: DataFrame, coverage: DataFrame) -> DataFrame:
    """Providers with their capabilities and coverage; none without a category tree."""
    return providers.join(coverage.select("provider", "coverage"), "provider", "left").withColumn(
        "coverage", F.when(F.col("categories_supported"), F.col("coverage"))
    )
