"""Incremental archives: what to probe, how to merge, what to derive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from statcube.functions.text import (
    TERRITORIAL_LEVELS, blank_to_null, query_parameter, territorial_level,
)
from statcube.model import ENTITY, check_entity
from statcube.operators.series import ranked

# Retry waits double from one day to at most 64;
# dimension names that are always territorial; category that marks a release.
RETRY_DAYS = 1
MAX_DOUBLINGS = 6
TERRITORIAL_PREFIX = "ITTER"
TERRITORIAL_DIM = "REF_AREA"
RELEASE_CATEGORY = "Data release"

ARCHIVE_ORDER = (*ENTITY, "dimension_id", "code_id")


def retry_wait(error_count: Column) -> Column:
    """Days to wait after this many failures in a row."""
    doublings = F.least(F.greatest(error_count - 1, F.lit(0)), F.lit(MAX_DOUBLINGS))
    return (F.lit(RETRY_DAYS) * F.pow(F.lit(2.0), doublings)).cast("int")


def _is_due(today: str) -> Column:
    return F.datediff(F.lit(today).cast("date"), "checked_at") >= retry_wait(F.col("error_count"))


def retry_due(status: DataFrame, today: str) -> DataFrame:
    """Failed dataflows whose wait is over."""
    return status.where((F.col("status") == "error") & _is_due(today))


def pick_candidates(
    catalog: DataFrame, status: DataFrame, today: str, stale_days: int, budget: int
) -> DataFrame:
    """The next dataflows to probe: new ones, then due failures, then stale ones.

    New ones go by id, the others oldest check first; ``budget`` rows are the result.
    """
    check_entity(catalog, status)
    known = status.select(*ENTITY, "status", "error_count", F.to_date("checked_at").alias("checked_at"))
    age = F.datediff(F.lit(today).cast("date"), "checked_at")
    turn = (
        F.when(F.col("status").isNull(), 0)
        .when((F.col("status") == "error") & _is_due(today), 1)
        .when((F.col("status") != "error") & (age > stale_days), 2)
    )
    return (
        catalog.join(known, [*ENTITY], "left").withColumn("turn", turn)
        .where(F.col("turn").isNotNull())
        .orderBy("turn", "checked_at", "df_id", "provider").limit(budget)
        .select(*catalog.columns, "turn")
    )


def probe_outcome(probes: DataFrame, codes: DataFrame, previous: DataFrame, today: str) -> DataFrame:
    """Status rows of a probe run.

    ``probes``: provider, df_id, df_description, source, error (null = answered).  ``codes``: provider,
    df_id, dimension_id, code_id as landed.  A failure adds one to the error count, an answer
    resets it; an answer without codes is ``empty``.
    """
    check_entity(probes, codes, previous)
    found = codes.groupBy(*ENTITY).agg(
        F.count_distinct("dimension_id").alias("_dims"), F.count("code_id").alias("_codes")
    )
    failed = F.col("error").isNotNull()
    n_codes = F.coalesce("_codes", F.lit(0))
    return (
        probes.join(found, [*ENTITY], "left")
        .join(previous.select(*ENTITY, F.col("error_count").alias("_before")), [*ENTITY], "left")
        .select(
            *ENTITY, F.coalesce("df_description", F.lit("")).alias("df_description"),
            F.when(failed, "error").when(n_codes > 0, "ok").otherwise("empty").alias("status"),
            F.when(failed, "").otherwise(F.coalesce("source", F.lit(""))).alias("source"),
            F.when(failed, 0).otherwise(F.coalesce("_dims", F.lit(0))).cast("long").alias("n_dims"),
            F.when(failed, 0).otherwise(n_codes).cast("long").alias("n_codes"),
            F.when(failed, F.coalesce("_before", F.lit(0)) + 1).otherwise(0).cast("long").alias("error_count"),
            F.when(failed, F.col("error")).otherwise("").alias("last_error"),
            F.lit(today).cast("date").alias("checked_at"),
        )
    )


def merge_archive(existing: DataFrame, new: DataFrame, probed: DataFrame) -> DataFrame:
    """Replace the rows of successfully probed dataflows, keep all others.

    Not sorted here: writing the archive sorts it.
    """
    check_entity(existing, new, probed)
    kept = existing.join(probed.select(*ENTITY).distinct(), [*ENTITY], "left_anti")
    return kept.unionByName(new.select(*existing.columns))


def touched_archive(existing: DataFrame, new: DataFrame, probed: DataFrame, partition: str = "provider") -> DataFrame:
    """The merged rows of those partitions alone that hold a probed dataflow.

    Written with dynamic overwrite they replace their partitions; the others are neither read nor written.
    """
    check_entity(existing, new, probed)
    touched = probed.select(partition).distinct()
    return merge_archive(existing.join(touched, partition, "left_semi"), new, probed)


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str], stamp: str = "cached_at") -> DataFrame:
    """Insert or replace by key: the newest row stays, on a tie the incoming one."""
    both = table.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    rest = [c for c in table.columns if c not in keys and c != stamp]
    newest = [F.col(stamp).desc_nulls_last(), F.desc("_new"), *[F.col(c).desc_nulls_last() for c in rest]]
    return ranked(both, keys, newest, 1).select(*table.columns)


def blacklist_upsert(blacklist: DataFrame, rows: DataFrame, marked_at: str) -> DataFrame:
    """Add or replace blacklisted ids, marked at the given time."""
    when = F.lit(marked_at).cast(blacklist.schema["marked_at"].dataType)
    check_entity(blacklist, rows)
    marked = rows.select(*ENTITY, when.alias("marked_at"), "description")
    return upsert(blacklist.select(*ENTITY, "marked_at", "description"), marked, ENTITY, "marked_at")


def blacklist_remove(blacklist: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What remains, and for each id to remove whether it was listed."""
    check_entity(blacklist, ids)
    asked = ids.select(*ENTITY).distinct()
    listed = blacklist.select(*ENTITY).distinct().withColumn("_listed", F.lit(True))
    existed = asked.join(listed, [*ENTITY], "left").select(
        *ENTITY, F.coalesce("_listed", F.lit(False)).alias("existed")
    )
    return blacklist.join(asked, [*ENTITY], "left_anti"), existed


def blacklist_list(blacklist: DataFrame) -> DataFrame:
    return blacklist.orderBy(F.col("marked_at").desc_nulls_last(), *ENTITY)


def archive_stats(status: DataFrame) -> DataFrame:
    """Dataflows per probe status and the codes archived for them."""
    return status.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_dataflows"), F.sum(F.coalesce("n_codes", F.lit(0))).alias("n_codes")
    )


# --- territorial view --------------------------------------------------------


def territorial_dims(catalog: DataFrame) -> DataFrame:
    """Dimension names the catalog declares as territorial."""
    named = F.nullif(F.col("df_geo_dim"), F.lit(""))
    return catalog.select(named.alias("dimension_id")).where("dimension_id IS NOT NULL").distinct()


def territorial_view(archive: DataFrame, status: DataFrame, dims: DataFrame) -> DataFrame:
    """Territorial detail per dataflow and territorial dimension.

    Only the dimension name decides what is territorial.  All its codes count; groups
    in which no code has a known shape are left out.
    """
    check_entity(archive, status)
    by_name = F.col("dimension_id").startswith(TERRITORIAL_PREFIX) | (F.col("dimension_id") == TERRITORIAL_DIM)
    declared = dims.select("dimension_id").distinct().withColumn("_declared", F.lit(True))
    territorial = archive.join(declared, "dimension_id", "left").where(by_name | F.col("_declared"))
    names = F.array(*[F.lit(level) for level in TERRITORIAL_LEVELS])
    place = F.array_position(names, territorial_level(F.col("code_id")))
    groups = (
        territorial.groupBy(*ENTITY, "dimension_id")
        .agg(F.array_sort(F.collect_set(place)).alias("_places"), F.count(F.lit(1)).alias("n_territories"))
        .where(F.size("_places") > 0)
        .withColumn("_levels", F.transform("_places", lambda i: F.get(names, (i - 1).cast("int"))))
    )
    facts = status.select(*ENTITY, "df_description", F.col("checked_at").cast("string").alias("checked_at"))
    return groups.join(facts, [*ENTITY], "left").select(
        *ENTITY, F.coalesce("df_description", F.lit("")).alias("df_description"), "dimension_id",
        F.element_at("_levels", -1).alias("max_level"), F.array_join("_levels", "|").alias("levels"),
        "n_territories", F.coalesce("checked_at", F.lit("")).alias("checked_at"),
    )


def dataflows_at_level(archive: DataFrame, level: str) -> DataFrame:
    """Dataflows with at least one code of a territorial level."""
    check_entity(archive)
    return archive.where(territorial_level(F.col("code_id")) == level).select(*ENTITY).distinct()


# --- descriptions ------------------------------------------------------------


def metadata_links(urls: DataFrame, url: str = "url") -> DataFrame:
    """Report id, metadata set id and base address in the URL; incomplete rows go."""
    check_entity(urls)
    link = F.col(url)
    return urls.select(
        *ENTITY, query_parameter(link, "reportId").alias("report_id"),
        query_parameter(link, "metadataSetId").alias("metadata_set_id"),
        query_parameter(link, "BaseUrlMDA").alias("base_url"),
    ).dropna(subset=["report_id", "metadata_set_id", "base_url"])


def reports_to_fetch(links: DataFrame, existing: DataFrame) -> DataFrame:
    """Reports not harvested yet, each once however many dataflows refer to it."""
    reports = links.groupBy("report_id").agg(F.max(F.struct("metadata_set_id", "base_url")).alias("_r"))
    return reports.select("report_id", "_r.*").join(existing.select("report_id").distinct(), "report_id", "left_anti")


def describe_dataflows(links: DataFrame, reports: DataFrame, harvested_at: str) -> DataFrame:
    """Text of a report for every dataflow that refers to it; no text, no row."""
    check_entity(links)
    texts = reports.where(blank_to_null(F.col("description")).isNotNull()).select(
        "report_id", "description", blank_to_null(F.col("siqual_id")).alias("siqual_id")
    )
    return (
        links.join(texts, "report_id")
        .select(
            *ENTITY, "description", "report_id", "metadata_set_id", "siqual_id",
            F.lit(harvested_at).cast("date").alias("harvested_at"),
        )
        .orderBy(*ENTITY)
    )


def harvest_stats(descriptions: DataFrame, links: DataFrame) -> DataFrame:
    """One row: dataflows covered and uncovered, reports, and those with a link id."""
    check_entity(descriptions, links)
    described = descriptions.select(*ENTITY, "report_id", "siqual_id")
    linked = links.select(F.col("provider").alias("_provider"), F.col("df_id").alias("_linked"))
    same = (F.col("provider") == F.col("_provider")) & (F.col("df_id") == F.col("_linked"))
    return described.join(linked, same, "full").agg(
        F.count("df_id").alias("n_covered"),
        F.count_distinct("report_id").alias("n_reports"),
        F.count("siqual_id").alias("n_with_link_id"),
        F.count_if(F.col("df_id").isNull()).alias("n_uncovered"),
    )


def release_feed(events: DataFrame, today: str, theme: str | None = None, n: int = 10) -> DataFrame:
    """The newest releases up to today."""
    past = events.where(F.array_contains("categories", RELEASE_CATEGORY) & (F.col("date") <= today))
    if theme:
        past = past.where(F.col("theme") == theme)
    return past.orderBy(F.desc("date"), "uid").limit(n)
