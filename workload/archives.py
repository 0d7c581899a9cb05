"""Queries on incremental archives, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from statcube.functions.text import clean_prose, link_id, territorial_level
from statcube.operators import archive
from statcube.session import cut_lineage
from statcube.sources import tabular
from statcube.streaming import jobs
from workload.registry import Data, query
from workload.views import flow_of

TODAY = "2001-08-01"
WAIT = "least(pow(2, greatest(error_count - 1, 0)), 64)"
LEVEL = """
    CASE WHEN code_id = 'IT' THEN 'nazionale' WHEN regexp_full_match(code_id, 'IT[A-Z0-9]') THEN 'ripartizione'
         WHEN regexp_full_match(code_id, 'IT[A-Z0-9][A-Z0-9]') THEN 'regione'
         WHEN regexp_full_match(code_id, 'IT[A-Z0-9][A-Z0-9][A-Z0-9]') THEN 'provincia'
         WHEN regexp_full_match(code_id, '[0-9]{6}') THEN 'comune' END
"""

# --- blacklist ---------------------------------------------------------------


@query("blacklist_upsert", """
    WITH fresh AS (SELECT @flow(p_partkey), p_name FROM {part} WHERE p_type = 'LARGE')
    SELECT provider, df_id, TIMESTAMP '2002-01-01' AS marked_at, p_name AS description FROM fresh
    UNION ALL SELECT provider, df_id, marked_at, description FROM {blacklist} ANTI JOIN fresh USING (provider, df_id)
""")
def _(d: Data) -> DataFrame:
    rows = d.part.where("p_type = 'LARGE'").select(
        *flow_of("p_partkey"), F.col("p_name").alias("description")
    )
    return archive.blacklist_upsert(d.blacklist, rows, "2002-01-01")


@query("blacklist_remove", """
    SELECT provider, df_id, (provider, df_id) IN (SELECT (provider, df_id) FROM {blacklist}) AS existed,
           (SELECT count(*) FROM {blacklist} WHERE (provider, df_id) NOT IN (
                SELECT (provider, df_id) FROM {flows} WHERE provider = 'PROMO')) AS n_left
    FROM {flows} WHERE provider = 'PROMO'
""")
def _(d: Data) -> DataFrame:
    left, existed = archive.blacklist_remove(d.blacklist, d.flows.where("provider = 'PROMO'"))
    return existed.withColumn("n_left", left.agg(F.count(F.lit(1))).scalar())


@query("blacklist_list", "SELECT provider, df_id, marked_at, description FROM {blacklist}")
def _(d: Data) -> DataFrame:
    return archive.blacklist_list(d.blacklist)


# --- probing -----------------------------------------------------------------


@query("retry_due", f"""
    SELECT provider, df_id, error_count, checked_at FROM {{status}}
    WHERE status = 'error' AND DATE '{TODAY}' - checked_at >= {WAIT}
""")
def _(d: Data) -> DataFrame:
    return archive.retry_due(d.status, TODAY).select("provider", "df_id", "error_count", "checked_at")


@query("pick_candidates", f"""
    SELECT provider, df_id, df_description, turn FROM (
        SELECT f.provider, f.df_id, f.df_description, checked_at, CASE WHEN status IS NULL THEN 0
               WHEN status = 'error' AND DATE '{TODAY}' - checked_at >= {WAIT} THEN 1
               WHEN status <> 'error' AND DATE '{TODAY}' - checked_at > 700 THEN 2 END AS turn
        FROM {{flows}} f LEFT JOIN (SELECT provider, df_id, status, error_count, checked_at FROM {{status}}) s
          ON f.df_id = s.df_id AND f.provider = s.provider)
    WHERE turn IS NOT NULL ORDER BY turn, checked_at NULLS FIRST, df_id, provider LIMIT 1500
""")
def _(d: Data) -> DataFrame:
    picked = archive.pick_candidates(d.flows, d.status, TODAY, 700, 1500)
    return picked.select("provider", "df_id", "df_description", "turn")


@query("probe_outcome", """
    WITH found AS (SELECT provider, df_id, count(DISTINCT dimension_id) AS n_dims, count(*) AS n_codes FROM {avail}
                   WHERE code_id <> 'R' GROUP BY ALL)
    SELECT provider, df_id, coalesce(f.df_description, '') AS df_description,
           CASE WHEN provider = 'LARGE' THEN 'error' WHEN provider = 'SMALL' THEN 'empty' ELSE 'ok' END AS status,
           CASE WHEN provider = 'LARGE' THEN '' ELSE 'hub' END AS source,
           CASE WHEN provider NOT IN ('LARGE', 'SMALL') THEN n_dims ELSE 0 END AS n_dims,
           CASE WHEN provider NOT IN ('LARGE', 'SMALL') THEN n_codes ELSE 0 END AS n_codes,
           CASE WHEN provider = 'LARGE' THEN coalesce(error_count, 0) + 1 ELSE 0 END AS error_count,
           CASE WHEN provider = 'LARGE' THEN repeat('no answer ', 30) ELSE '' END AS last_error,
           DATE '2001-08-01' AS checked_at
    FROM {flows} f JOIN found USING (provider, df_id) LEFT JOIN (SELECT provider, df_id, error_count FROM {status}) s
      USING (provider, df_id)
""")
def _(d: Data) -> DataFrame:
    found = d.avail.where("code_id <> 'R'")
    probed = d.flows.join(found.select("provider", "df_id"), ["provider", "df_id"], "left_semi")
    failure = F.when(F.col("provider") == "LARGE", F.repeat(F.lit("no answer "), 30))
    probes = probed.select("provider", "df_id", "df_description", F.lit("hub").alias("source"), failure.alias("error"))
    answered = found.where("provider <> 'SMALL'").join(d.flows.select("provider", "df_id"), ["provider", "df_id"], "left_semi")
    return archive.probe_outcome(probes, answered, d.status, TODAY)


@query("merge_archive", """
    WITH fresh AS (SELECT provider, df_id, dimension_id, code_id, DATE '2001-08-01' AS checked_at FROM {avail}
                   WHERE dimension_id = 'FLAG')
    SELECT * FROM {archive} ANTI JOIN fresh USING (provider, df_id) UNION ALL SELECT * FROM fresh
""")
def _(d: Data) -> DataFrame:
    fresh = d.avail.where("dimension_id = 'FLAG'").withColumn("checked_at", F.lit(TODAY).cast("date"))
    return archive.merge_archive(d.archive, fresh, fresh)


@query("touched_archive", """
    WITH fresh AS (SELECT provider, df_id, dimension_id, code_id, DATE '2001-08-01' AS checked_at FROM {avail}
                   WHERE dimension_id = 'FLAG' AND provider IN ('PROMO', 'SMALL'))
    SELECT * FROM {archive} ANTI JOIN fresh USING (provider, df_id) UNION ALL SELECT * FROM fresh
""")
def _(d: Data) -> DataFrame:
    # Two providers are probed: only their partitions of the stored archive are written again.
    path = d.scratch("archive") + ".parquet"
    tabular.write_archive(d.archive, path, "provider")
    mine = d.avail.where("dimension_id = 'FLAG' AND provider IN ('PROMO', 'SMALL')")
    fresh = mine.withColumn("checked_at", F.lit(TODAY).cast("date"))
    merged = archive.touched_archive(d.spark.read.schema(d.archive.schema).parquet(path), fresh, fresh)
    tabular.write_archive(cut_lineage(merged), path, "provider")
    return d.spark.read.schema(d.archive.schema).parquet(path)


@query("upsert", """
    SELECT o_custkey AS k, o_orderdate AS cached_at, o_orderkey AS v FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END DESC, o_orderkey DESC) AS r FROM {orders}) WHERE r = 1
""")
def _(d: Data) -> DataFrame:
    rows = d.orders.select(
        F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("cached_at"), F.col("o_orderkey").alias("v"),
        "o_orderstatus",
    )
    incoming = rows.where("o_orderstatus = 'F'").drop("o_orderstatus")
    return archive.upsert(rows.where("o_orderstatus <> 'F'").drop("o_orderstatus"), incoming, ["k"])


@query("archive_stats", """
    SELECT status, count(*) AS n_dataflows, cast(sum(coalesce(n_codes, 0)) AS BIGINT) AS n_codes FROM {status}
    GROUP BY status
""")
def _(d: Data) -> DataFrame:
    return archive.archive_stats(d.status)


# --- territorial view --------------------------------------------------------


@query("territorial_dims", "SELECT DISTINCT df_geo_dim AS dimension_id FROM {flows} WHERE df_geo_dim <> ''")
def _(d: Data) -> DataFrame:
    return archive.territorial_dims(d.flows)


@query("territorial_level", f"SELECT provider, df_id, dimension_id, code_id, {LEVEL} AS level FROM {{archive}}")
def _(d: Data) -> DataFrame:
    return d.archive.select("provider", "df_id", "dimension_id", "code_id", territorial_level(F.col("code_id")).alias("level"))


@query("territorial_view", f"""
    WITH steps(level, step) AS (VALUES ('nazionale', 1), ('ripartizione', 2), ('regione', 3), ('provincia', 4),
                                       ('comune', 5)),
    t AS (SELECT provider, df_id, dimension_id, {LEVEL} AS level FROM {{archive}} WHERE starts_with(dimension_id, 'ITTER')
          OR dimension_id = 'REF_AREA' OR dimension_id IN (SELECT df_geo_dim FROM {{flows}} WHERE df_geo_dim <> '')),
    n AS (SELECT provider, df_id, dimension_id, count(*) AS n_territories FROM t GROUP BY ALL),
    l AS (SELECT provider, df_id, dimension_id, string_agg(level, '|' ORDER BY step) AS levels, arg_max(level, step) AS max_level
          FROM (SELECT DISTINCT provider, df_id, dimension_id, level FROM t) JOIN steps USING (level) GROUP BY ALL)
    SELECT provider, df_id, coalesce(s.df_description, '') AS df_description, dimension_id, max_level, levels, n_territories,
           coalesce(s.checked_at::VARCHAR, '') AS checked_at
    FROM l JOIN n USING (provider, df_id, dimension_id)
    LEFT JOIN (SELECT provider, df_id, df_description, checked_at FROM {{status}}) s USING (provider, df_id)
""")
def _(d: Data) -> DataFrame:
    return archive.territorial_view(d.archive, d.status, archive.territorial_dims(d.flows))


@query("dataflows_at_level", f"SELECT DISTINCT provider, df_id FROM {{archive}} WHERE {LEVEL} = 'comune'")
def _(d: Data) -> DataFrame:
    return archive.dataflows_at_level(d.archive, "comune")


# --- descriptions ------------------------------------------------------------

_PROSE = "html"
for _entity, _char in (("&amp;", "&"), ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')):
    _PROSE = f"replace({_PROSE}, '{_entity}', '{_char}')"


@query("clean_prose", f"""
    SELECT page_id, trim(regexp_replace(regexp_replace({_PROSE}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS prose
    FROM {{pages}}
""")
def _(d: Data) -> DataFrame:
    return d.pages.select("page_id", clean_prose(F.col("html")).alias("prose"))


@query("metadata_links", """
    SELECT @flow(page_id), 'R' || (page_id - page_id % 3) AS report_id, 'MS ' || (length(html) % 2) AS metadata_set_id,
           'https://api' AS base_url FROM {pages} WHERE url LIKE 'https%'
""")
def _(d: Data) -> DataFrame:
    return archive.metadata_links(d.page_links)


@query("reports_to_fetch", """
    SELECT DISTINCT report_id, metadata_set_id, base_url FROM {report_links}
    WHERE report_id NOT IN (SELECT report_id FROM {reports} WHERE siqual_id IS NOT NULL)
""")
def _(d: Data) -> DataFrame:
    return archive.reports_to_fetch(d.report_links, d.reports.where("siqual_id IS NOT NULL"))


@query("describe_dataflows", """
    SELECT provider, df_id, description, report_id, metadata_set_id, siqual_id, DATE '2001-08-01' AS harvested_at
    FROM {report_links} JOIN {reports} USING (report_id) WHERE trim(description) <> ''
""")
def _(d: Data) -> DataFrame:
    return archive.describe_dataflows(d.report_links, d.reports, TODAY)


@query("harvest_stats", """
    SELECT count(*) FILTER (trim(description) <> '') AS n_covered,
           count(DISTINCT report_id) FILTER (trim(description) <> '') AS n_reports,
           count(siqual_id) FILTER (trim(description) <> '') AS n_with_link_id,
           count(*) FILTER (coalesce(trim(description), '') = '') AS n_uncovered
    FROM {report_links} LEFT JOIN {reports} USING (report_id)
""")
def _(d: Data) -> DataFrame:
    return archive.harvest_stats(archive.describe_dataflows(d.report_links, d.reports, TODAY), d.report_links)


@query("link_id", """
    SELECT page_id, url, nullif(regexp_extract(url, '[?&]id=(\\w+)', 1), '') AS link_id
    FROM (SELECT page_id, CASE WHEN url LIKE 'https%' THEN url || '?id=00' || page_id ELSE url END AS url FROM {pages})
""")
def _(d: Data) -> DataFrame:
    marked = F.concat(F.col("url"), F.lit("?id=00"), F.col("page_id").cast("string"))
    url = F.when(F.col("url").like("https%"), marked).otherwise(F.col("url"))
    return d.pages.select("page_id", url.alias("url")).withColumn("link_id", link_id(F.col("url")))


# --- streams -----------------------------------------------------------------


def _event_stream(d: Data) -> DataFrame:
    stored = d.events
    return d.spark.readStream.schema(stored.schema).option("pathGlobFilter", "events*.parquet").parquet(d.folder)


@query("stream_available_codes", """
    SELECT DISTINCT 'EVENT' AS dimension_id, event_type AS code_id FROM {events}
    UNION SELECT 'PERSON', user_id::VARCHAR FROM {events}
""")
def _(d: Data) -> DataFrame:
    cube = _event_stream(d).select(F.col("event_type").alias("EVENT"), F.col("user_id").alias("PERSON"))
    target = d.scratch("codes")
    new_codes = jobs.stream_available_codes(cube, ["EVENT", "PERSON"])
    jobs.start_codes_archive(new_codes, f"{target}/table", f"{target}/progress").awaitTermination()
    return d.spark.read.parquet(f"{target}/table")


@query("stream_upsert", """
    SELECT user_id, event_type, ts, event_id FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM {events}) WHERE r = 1
""")
def _(d: Data) -> DataFrame:
    rows = _event_stream(d).select("user_id", "event_type", "ts", "event_id")
    target, keys = d.scratch("upserts"), ["user_id", "event_type"]
    jobs.stream_upsert(rows, keys, f"{target}/table", f"{target}/progress", "ts").awaitTermination()
    return jobs.read_upserted(d.spark, f"{target}/table", keys, "ts")
