"""How the given tables stand in for cubes, catalogs, codelists and archives.

Each view is one SELECT in the SQL that Spark and DuckDB share; ``{name}`` stands for
another view or a given table, and ``@flow(key)`` for the provider and id of the dataflow with a number.
Two neighbouring numbers are one id under two providers.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

PROVIDERS = ("PROMO", "LARGE", "SMALL", "MEDIUM", "STANDARD", "ECONOMY")


def provider_of(key: Column) -> Column:
    names = F.array(*[F.lit(p) for p in PROVIDERS])
    return F.get(names, (key % len(PROVIDERS)).cast("int")).alias("provider")


def flow_id_of(key: Column) -> Column:
    return F.concat(F.lit("DF_"), (key - key % 2).cast("string")).alias("df_id")


def flow_of(column: str) -> list[Column]:
    """Provider and id of the dataflow with the number in a column, as ``@flow`` in SQL."""
    return [provider_of(F.col(column)), flow_id_of(F.col(column))]


def with_flows(sql: str) -> str:
    """SQL with ``@provider(key)``, ``@id(key)`` and ``@flow(key)`` written out."""

    def provider(key: str) -> str:
        cases = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PROVIDERS))
        return f"CASE ({key}) % {len(PROVIDERS)} {cases} END"

    def flow_id(key: str) -> str:
        return f"concat('DF_', cast(({key}) - ({key}) % 2 AS string))"

    sql = re.sub(r"@provider\(([^()]*)\)", lambda m: provider(m[1]), sql)
    sql = re.sub(r"@id\(([^()]*)\)", lambda m: flow_id(m[1]), sql)
    return re.sub(r"@flow\(([^()]*)\)", lambda m: f"{provider(m[1])} AS provider, {flow_id(m[1])} AS df_id", sql)


VIEWS: dict[str, str] = {
    # Monthly cube: quantities per supplier, flag and status.  Summed before the join,
    # so a supplier with very many lines is already small when it is joined.
    "obs": """
        SELECT 'M' AS FREQ, cast(s.s_nationkey AS string) AS GEO, cast(a.l_suppkey AS string) AS SUPP,
               a.FLAG, a.STATUS, a.TIME_PERIOD, a.OBS_VALUE
        FROM (SELECT l_suppkey, l_returnflag AS FLAG, l_linestatus AS STATUS,
                     substr(cast(cast(l_shipdate AS date) AS string), 1, 7) AS TIME_PERIOD, sum(l_quantity) AS OBS_VALUE
              FROM {lineitem}
              GROUP BY l_suppkey, l_returnflag, l_linestatus, substr(cast(cast(l_shipdate AS date) AS string), 1, 7)) a
        JOIN {supplier} s ON s.s_suppkey = a.l_suppkey
    """,
    "obs_dates": """
        SELECT FREQ, GEO, SUPP, FLAG, STATUS, cast(concat(TIME_PERIOD, '-01') AS date) AS TIME_PERIOD, OBS_VALUE
        FROM {obs}
    """,
    # Daily cube of events.
    "obs_daily": """
        SELECT event_type AS EVENT, cast(user_id AS string) AS PERSON,
               cast(cast(ts AS date) AS string) AS TIME_PERIOD, cast(count(*) AS double) AS OBS_VALUE
        FROM {events} GROUP BY event_type, cast(user_id AS string), cast(cast(ts AS date) AS string)
    """,
    # Period texts of every form, from order dates.
    "periods": """
        SELECT o_orderkey,
               CASE o_orderkey % 9
                    WHEN 0 THEN substr(d, 1, 4)
                    WHEN 1 THEN substr(d, 1, 7)
                    WHEN 2 THEN concat(substr(d, 1, 4), '-Q', cast(1 + o_orderkey % 4 AS string))
                    WHEN 3 THEN concat(substr(d, 1, 4), '-S', cast(1 + o_orderkey % 2 AS string))
                    WHEN 4 THEN concat(substr(d, 1, 4), '-W', lpad(cast(o_orderkey % 54 AS string), 2, '0'))
                    WHEN 5 THEN substr(d, 1, 10)
                    WHEN 6 THEN concat(' ', substr(d, 1, 4), '-13')
                    WHEN 7 THEN concat(substr(d, 1, 4), '-02-30')
                    ELSE o_orderpriority END AS period
        FROM (SELECT o_orderkey, o_orderpriority, cast(cast(o_orderdate AS date) AS string) AS d FROM {orders}) x
    """,
    # Codelists (column ``ord`` is the order).  Flag R has no name on purpose.
    "codes": """
        SELECT 'CL_GEO' AS codelist_id, 'en' AS lang, cast(n_nationkey AS string) AS id, n_name AS name,
               concat('R', cast(n_regionkey AS string)) AS parent, cast(n_nationkey AS bigint) AS ord
        FROM {nation}
        UNION ALL SELECT 'CL_GEO', 'it', cast(n_nationkey AS string), lower(n_name),
               concat('R', cast(n_regionkey AS string)), cast(n_nationkey AS bigint) FROM {nation}
        UNION ALL SELECT 'CL_GEO', 'en', concat('R', cast(r_regionkey AS string)), r_name, cast(NULL AS string),
               cast(NULL AS bigint) FROM {region}
        UNION ALL SELECT 'CL_SUPP', 'en', cast(s_suppkey AS string), s_name, cast(s_nationkey AS string),
               cast(s_suppkey AS bigint) FROM {supplier}
        UNION ALL SELECT 'CL_FLAG', 'en', id, name, cast(NULL AS string), cast(NULL AS bigint)
               FROM (VALUES ('A', 'Accepted'), ('N', 'None')) AS f(id, name)
        UNION ALL SELECT 'CL_STATUS', 'en', id, name, cast(NULL AS string), cast(NULL AS bigint)
               FROM (VALUES ('O', 'Open'), ('F', 'Final')) AS g(id, name)
    """,
    # Catalogs: whole document texts, and parts with short shared names.
    "catalog": """
        SELECT CASE doc_id % 2 WHEN 0 THEN 'P0' ELSE 'P1' END AS provider,
               concat(CASE WHEN doc_id % 4 < 2 THEN 'SRC1_' ELSE 'SRC2_' END, cast(doc_id - doc_id % 2 AS string)) AS df_id,
               '1.0' AS version, text AS df_description, source AS df_structure_id, doc_id
        FROM {documents}
    """,
    "flows": """
        SELECT @flow(p_partkey), '1.0' AS version,
               CASE WHEN p_size = 7 THEN NULL ELSE p_name END AS df_description,
               CASE WHEN p_size = 9 THEN NULL ELSE p_brand END AS df_structure_id,
               CASE WHEN p_type = 'PROMO' THEN 'RESIDENCE_TERR' WHEN p_type = 'LARGE' THEN '' END AS df_geo_dim
        FROM {part}
    """,
    # Data structures: one per brand, dimensions named by part type.
    "dims": """
        SELECT p_brand AS structure_id, p_type AS dimension_id, min(p_size) AS position,
               CASE WHEN p_type <> 'SMALL' THEN concat('CL_', p_type) END AS codelist_id
        FROM {part} GROUP BY p_brand, p_type
    """,
    "dims_of_flows": """
        SELECT DISTINCT dimension_id, codelist_id FROM (VALUES ('FLAG', 'CL_FLAG'), ('STATUS', 'CL_STATUS'),
               ('SUPP', 'CL_SUPP'), ('GEO', 'CL_GEO')) AS d(dimension_id, codelist_id)
    """,
    # Category tree: a scheme per region, nations, then suppliers.
    "adjacency": """
        SELECT r_name AS scheme_id, n_name AS id, cast(NULL AS string) AS parent, lower(n_name) AS cat_name
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
        UNION ALL
        SELECT r_name, concat('S', cast(s_suppkey AS string)), n_name, s_name
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    """,
    "categories": """
        SELECT scheme_id, concat('Region ', scheme_id) AS scheme_name, id AS cat_id,
               CASE WHEN parent IS NULL THEN id ELSE concat(parent, '.', id) END AS cat_path, cat_name,
               cast(NULL AS string) AS cat_description, coalesce(parent, '') AS parent_path,
               CASE WHEN parent IS NULL THEN 1 ELSE 2 END AS depth
        FROM {adjacency}
    """,
    # Which dataflow sits in which category: n to m.
    "links": """
        SELECT @flow(l_partkey), r_name AS scheme_id,
               concat(n_name, '.S', cast(s_suppkey AS string)) AS cat_path
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM {lineitem}) p
        JOIN {supplier} ON l_suppkey = s_suppkey
        JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    """,
    "context": """
        SELECT @flow(l_partkey), max(l_shipmonth) AS cat_context,
               min(l_returnflag) AS cat_primary
        FROM (SELECT l_partkey, substr(cast(cast(l_shipdate AS date) AS string), 1, 7) AS l_shipmonth, l_returnflag
              FROM {lineitem}) x
        GROUP BY l_partkey
    """,
    # Codes occurring per dataflow.
    "avail": """
        SELECT DISTINCT provider, df_id, dimension_id, code_id
        FROM (SELECT @flow(l_partkey), l_returnflag AS FLAG, l_linestatus AS STATUS,
                     cast(l_suppkey AS string) AS SUPP FROM {lineitem})
        UNPIVOT (code_id FOR dimension_id IN (FLAG, STATUS, SUPP))
    """,
    # Probe status: every second dataflow was probed before.
    "status": """
        SELECT @flow(2 * o_orderkey + o_orderkey % 2), o_orderpriority AS df_description,
               CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'error' ELSE 'empty' END AS status,
               'hub' AS source, cast(o_custkey % 5 AS bigint) AS n_dims,
               CASE WHEN o_orderstatus = 'F' THEN cast(o_custkey % 50 AS bigint) END AS n_codes,
               cast(o_custkey % 9 AS bigint) AS error_count, '' AS last_error, cast(o_orderdate AS date) AS checked_at
        FROM {orders}
    """,
    # Archive with territorial codes of every level and some without one.
    "archive": """
        SELECT @flow(c_custkey - c_custkey % 4 + CASE WHEN c_custkey % 4 < 2 THEN 0 ELSE 1 END),
               CASE c_mktsegment WHEN 'BUILDING' THEN 'ITTER107' WHEN 'MACHINERY' THEN 'REF_AREA'
                    WHEN 'HOUSEHOLD' THEN 'RESIDENCE_TERR' WHEN 'AUTOMOBILE' THEN 'ECOICOP_2' ELSE 'AGE' END
                    AS dimension_id,
               CASE c_custkey % 6 WHEN 0 THEN 'IT' WHEN 1 THEN 'ITC' WHEN 2 THEN 'ITC4' WHEN 3 THEN 'IT108'
                    WHEN 4 THEN lpad(cast(c_custkey AS string), 6, '0') ELSE 'IT108_NC' END AS code_id,
               cast('2024-01-01' AS date) AS checked_at
        FROM {customer}
    """,
    # Blacklisted dataflows with the time they were marked.
    "blacklist": """
        SELECT @flow(o_custkey), max(o_orderdate) AS marked_at,
               max(o_orderpriority) AS description
        FROM {orders} WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey
    """,
    # Metadata links; those without a report are plain page addresses.
    "page_links": """
        SELECT @flow(page_id),
               CASE WHEN url LIKE 'https%' THEN concat('https://md.example.org/v?reportId=R',
                         cast(page_id - page_id % 3 AS string),
                         '&metadataSetId=MS%20', cast(length(html) % 2 AS string), '&BaseUrlMDA=https%3A%2F%2Fapi')
                    ELSE url END AS url
        FROM {pages}
    """,
    "report_links": """
        SELECT @flow(page_id), concat('R', cast(page_id - page_id % 3 AS string))
               AS report_id, 'MS' AS metadata_set_id, 'https://api' AS base_url FROM {pages}
    """,
    "reports": """
        SELECT concat('R', cast(doc_id AS string)) AS report_id,
               CASE WHEN lang = 'de' THEN '' ELSE text END AS description,
               CASE WHEN lang = 'en' THEN concat('00', cast(n_chars AS string)) END AS siqual_id
        FROM {documents}
    """,
    # Calendar events, one per order.
    "releases": """
        SELECT concat('U', cast(o_orderkey AS string)) AS uid, o_orderpriority AS summary,
               cast(cast(o_orderdate AS date) AS string) AS date,
               CASE o_orderstatus WHEN 'F' THEN 'economy' WHEN 'O' THEN 'science' ELSE 'transport' END AS theme,
               CASE WHEN o_custkey % 2 = 0 THEN 'Data release' ELSE 'News' END AS category
        FROM {orders}
    """,
    # Vectors under their dataflow id; only those with a quality label are in the catalog.
    "vectors": """
        SELECT @flow(vec_id), embedding, label FROM {embeddings}
    """,
    "vector_catalog": """
        SELECT @flow(doc_id), concat('quality ', cast(quality AS string))
               AS df_description
        FROM {labels}
    """,
}
VIEWS = {name: with_flows(sql) for name, sql in VIEWS.items()}
