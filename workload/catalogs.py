"""Queries on catalogs: labels, joins, availability, category trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from statcube.functions.text import compose_title
from statcube.operators import analyze, catalog, codes, labels, tree
from workload.cubes import DIMS
from workload.registry import Data, query
from workload.views import flow_id_of, flow_of, provider_of

# The dataflow that queries on one dataflow take: number 3, whose id number 2 has with another provider.
FLOW = ("MEDIUM", "DF_2")

# --- labels ------------------------------------------------------------------


@query("enrich_labels", """
    SELECT o.*, g.name AS GEO_label, s.name AS SUPP_label, f.name AS FLAG_label, t.name AS STATUS_label
    FROM {obs} o
    LEFT JOIN (SELECT id, name FROM {codes} WHERE codelist_id = 'CL_GEO' AND lang = 'en') g ON GEO = g.id
    LEFT JOIN (SELECT id, name FROM {codes} WHERE codelist_id = 'CL_SUPP') s ON SUPP = s.id
    LEFT JOIN (SELECT id, name FROM {codes} WHERE codelist_id = 'CL_FLAG') f ON FLAG = f.id
    LEFT JOIN (SELECT id, name FROM {codes} WHERE codelist_id = 'CL_STATUS') t ON STATUS = t.id
""")
def _(d: Data) -> DataFrame:
    lists = {"geo": "CL_GEO", "supp": "CL_SUPP", "flag": "CL_FLAG", "status": "CL_STATUS", "freq": None}
    return labels.enrich_labels(d.obs, lists, d.codelists, "en")


@query("describe_filters", """
    WITH asked(dimension_id, value, codelist_id) AS (VALUES ('GEO', '7', 'CL_GEO'), ('SUPP', '12', 'CL_SUPP'),
         ('FLAG', 'A+N', 'CL_FLAG'), ('STATUS', 'X', 'CL_STATUS'))
    SELECT dimension_id, value, coalesce(name, '') AS description FROM asked LEFT JOIN (
        SELECT codelist_id, id, name FROM {codes} WHERE lang = 'en') c
      ON c.codelist_id = asked.codelist_id AND id = value
""")
def _(d: Data) -> DataFrame:
    chosen = {"GEO": ["7"], "SUPP": "12", "FLAG": "A+N", "STATUS": "X", "FREQ": "."}
    lists = {"GEO": "CL_GEO", "SUPP": "CL_SUPP", "FLAG": "CL_FLAG", "STATUS": "CL_STATUS", "FREQ": None}
    return labels.describe_filters(d.spark, chosen, lists, d.codelists, "en")


@query("constraint_labels", """
    SELECT code_id AS id, coalesce(name, '') AS name
    FROM (SELECT DISTINCT code_id FROM {avail} WHERE dimension_id = 'FLAG' AND provider = 'MEDIUM' AND df_id = 'DF_2') a
    LEFT JOIN (SELECT id, name FROM {codes} WHERE codelist_id = 'CL_FLAG') c ON a.code_id = c.id
""")
def _(d: Data) -> DataFrame:
    return labels.constraint_labels(d.avail, labels.codelist_names(d.codelists, "CL_FLAG"), "flag", *FLOW)


@query("values_in_dataflow", """
    SELECT cast(c_custkey AS VARCHAR) AS id, c_name AS name,
           cast(c_custkey AS VARCHAR) IN (SELECT code_id FROM {avail} WHERE dimension_id = 'SUPP' AND provider = 'MEDIUM' AND df_id = 'DF_2') AS in_dataflow,
           cast(NULL AS BOOLEAN) AS in_other
    FROM {customer}
""")
def _(d: Data) -> DataFrame:
    names = d.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    known = labels.values_in_dataflow(names, d.avail, "supp", *FLOW)
    unknown = labels.values_in_dataflow(names, d.avail, "PORT", *FLOW)
    return known.join(unknown.select("id", F.col("in_dataflow").alias("in_other")), "id")


@query("membership_counts", """
    SELECT count(*) AS n_total, count(*) FILTER (cast(c_custkey AS VARCHAR) IN (
           SELECT code_id FROM {avail} WHERE dimension_id = 'SUPP')) AS n_present
    FROM {customer}
""")
def _(d: Data) -> DataFrame:
    names = d.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    return labels.membership_counts(labels.values_in_dataflow(names, d.avail, "SUPP"))


@query("metadata_companion", """
    WITH many AS (SELECT provider, df_id, dimension_id FROM {avail} GROUP BY ALL HAVING count(DISTINCT code_id) > 1)
    SELECT provider, df_id, dimension_id AS dimension, code_id AS code, name AS label
    FROM {avail} JOIN many USING (provider, df_id, dimension_id) JOIN {dims_of_flows} USING (dimension_id)
    LEFT JOIN (SELECT codelist_id, id, name FROM {codes} WHERE lang = 'en') c
      ON c.codelist_id = dims_of_flows.codelist_id AND c.id = code_id
""")
def _(d: Data) -> DataFrame:
    return labels.metadata_companion(d.avail, d.dims_of_flows, d.codelists.where("lang = 'en'"))


@query("label_join_replace", """
    SELECT FREQ, GEO, s_name AS supplier, FLAG, STATUS, TIME_PERIOD, OBS_VALUE
    FROM {obs} JOIN {supplier} ON SUPP = cast(s_suppkey AS VARCHAR)
""")
def _(d: Data) -> DataFrame:
    return labels.label_join_replace(d.obs, "SUPP", labels.codelist_names(d.codelists, "CL_SUPP"), "supplier")


@query("dimensions_info", """
    SELECT provider, df_id, dimension_id, position, codelist_id, description
    FROM (SELECT provider, df_id, coalesce(df_structure_id, df_id) AS structure_id FROM {flows}) JOIN {dims} USING (structure_id)
    LEFT JOIN (SELECT 'CL_' || p_type AS codelist_id, min(p_name) AS description FROM {part} WHERE p_type <> 'LARGE'
               GROUP BY 1) i USING (codelist_id)
""")
def _(d: Data) -> DataFrame:
    info = d.part.where("p_type <> 'LARGE'").groupBy(F.concat(F.lit("CL_"), "p_type").alias("codelist_id")).agg(
        F.min("p_name").alias("description")
    )
    return labels.dimensions_info(d.flows, d.dims, info)


@query("dimension_values", """
    SELECT DISTINCT p_name AS id, upper(p_name) AS name FROM {part}
    WHERE 'CL_' || p_type IN (SELECT codelist_id FROM {dims} WHERE structure_id = 'Brand#5' AND dimension_id = 'MEDIUM')
""")
def _(d: Data) -> DataFrame:
    lists = d.part.select(
        F.concat(F.lit("CL_"), "p_type").alias("codelist_id"), F.col("p_name").alias("id"),
        F.upper("p_name").alias("name"), F.lit("en").alias("lang"),
    ).distinct()
    return labels.dimension_values(d.dims, lists, "Brand#5", "medium", "en")


# --- catalog joins -----------------------------------------------------------


@query("with_category_context", """
    SELECT provider, df_id, df_description, coalesce(cat_context, '') AS cat_context, cat_primary
    FROM {flows} LEFT JOIN (SELECT * FROM {context} WHERE cat_primary <> 'R') c USING (provider, df_id)
""")
def _(d: Data) -> DataFrame:
    joined = catalog.with_category_context(d.flows, d.context.where("cat_primary <> 'R'"))
    return joined.select("provider", "df_id", "df_description", "cat_context", "cat_primary")


@query("filter_by_category", """
    SELECT provider, df_id, df_description, scheme_id, cat_path FROM {flows} JOIN {links} USING (provider, df_id)
    WHERE cat_path = 'S7' OR cat_path LIKE '%.S7'
""")
def _(d: Data) -> DataFrame:
    hits = catalog.filter_by_category(d.flows, d.links, "S7")
    return hits.select("provider", "df_id", "df_description", "scheme_id", "cat_path")


@query("restrict_to_category", """
    SELECT provider, df_id, df_description FROM {flows}
    WHERE (provider, df_id) IN (SELECT (provider, df_id) FROM {links} WHERE cat_path LIKE '%.S7')
""")
def _(d: Data) -> DataFrame:
    return catalog.restrict_to_category(d.flows, d.links, "S7").select("provider", "df_id", "df_description")


@query("siblings", """
    SELECT l.scheme_id, coalesce(c.scheme_name, '') AS scheme_name, l.cat_path, coalesce(c.cat_name, '') AS cat_name,
           l.provider, l.df_id, coalesce(f.df_description, '') AS df_description, l.df_id = 'DF_4' AS is_target
    FROM {links} l JOIN (SELECT scheme_id, cat_path FROM {links} WHERE df_id = 'DF_4' AND provider = 'ECONOMY') t
      USING (scheme_id, cat_path)
    LEFT JOIN {categories} c USING (scheme_id, cat_path)
    LEFT JOIN {flows} f ON f.df_id = l.df_id AND f.provider = l.provider WHERE l.provider = 'ECONOMY'
""")
def _(d: Data) -> DataFrame:
    return catalog.siblings("ECONOMY", "df_4", d.links, d.categories, d.flows)


@query("category_dataflows", """
    SELECT scheme_id, cat_path, provider, df_id, coalesce(df_description, '') AS df_description
    FROM {links} LEFT JOIN (SELECT provider, df_id, df_description FROM {flows}) f USING (provider, df_id)
    WHERE scheme_id = 'ASIA'
""")
def _(d: Data) -> DataFrame:
    return catalog.category_dataflows(d.links, d.categories.where("scheme_id = 'ASIA'"), d.flows)


@query("invalid_codes", """
    WITH asked(dimension_id, code_id) AS (VALUES ('flag', 'A'), ('flag', 'X'), ('STATUS', 'F'), ('STATUS', 'Z'),
         ('SUPP', '3'), ('SUPP', '-1'), ('PORT', 'ANY'))
    SELECT * FROM asked WHERE upper(dimension_id) IN (SELECT dimension_id FROM {avail})
       AND NOT EXISTS (SELECT 1 FROM {avail} a WHERE a.dimension_id = upper(asked.dimension_id)
                       AND a.code_id = asked.code_id)
""")
def _(d: Data) -> DataFrame:
    asked = {"flag": "A+X", "STATUS": ["F", "Z"], "SUPP": "3+-1", "PORT": "ANY"}
    return catalog.invalid_codes(d.spark, asked, d.avail)


_LONG_IDS = """
    SELECT @provider(o_orderkey) AS provider, CASE WHEN o_orderpriority = '1-URGENT' THEN @id(o_custkey)
                ELSE @id(o_orderkey) || '_DF_' || o_custkey END AS long_id FROM {orders}
"""


def _long_ids(d: Data) -> DataFrame:
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    long_id = F.when(F.col("o_orderpriority") == "1-URGENT", flow_id_of(customer)).otherwise(
        F.concat(flow_id_of(order), F.lit("_DF_"), customer.cast("string")))
    return d.orders.select(provider_of(order), long_id.alias("long_id"))


@query("match_catalog_ids", f"""
    SELECT provider, long_id, CASE WHEN (provider, long_id) IN (SELECT (provider, df_id) FROM {{flows}}) THEN long_id
                         WHEN (provider, p) IN (SELECT (provider, df_id) FROM {{flows}}) THEN p END AS catalog_id
    FROM (SELECT provider, long_id, CASE WHEN contains(long_id, '_DF_') THEN split_part(long_id, '_DF_', 1) END AS p
          FROM ({_LONG_IDS}))
""")
def _(d: Data) -> DataFrame:
    return catalog.match_catalog_ids(_long_ids(d), d.flows)


@query("has_constraint_flag", f"""
    SELECT provider, df_id, (provider, df_id) IN (SELECT (provider, long_id) FROM ({_LONG_IDS})) OR (provider, df_id) IN (
               SELECT (provider, split_part(long_id, '_DF_', 1)) FROM ({_LONG_IDS}) WHERE contains(long_id, '_DF_'))
           AS has_constraint FROM {{flows}}
""")
def _(d: Data) -> DataFrame:
    matched = catalog.match_catalog_ids(_long_ids(d), d.flows)
    return catalog.has_constraint_flag(d.flows, matched, True).select("provider", "df_id", "has_constraint")


@query("resolve_dataflows", """
    WITH asked AS (SELECT DISTINCT @provider(o_custkey) AS provider, lower(@id(o_orderkey)) AS identifier FROM {orders}
                   UNION SELECT DISTINCT @provider(p_partkey), upper(p_brand) FROM {part}
                   UNION SELECT DISTINCT @provider(p_size), p_name FROM {part}),
    by_id AS (SELECT provider, upper(df_id) AS k, min(df_id) AS a FROM {flows} GROUP BY ALL),
    by_structure AS (SELECT provider, upper(df_structure_id) AS k, min(df_id) AS b FROM {flows} GROUP BY ALL),
    by_title AS (SELECT provider, df_description AS k, min(df_id) AS c FROM {flows} GROUP BY ALL)
    SELECT asked.provider, identifier, coalesce(a, b, c) AS df_id FROM asked
    LEFT JOIN by_id i ON i.provider = asked.provider AND i.k = upper(identifier)
    LEFT JOIN by_structure s ON s.provider = asked.provider AND s.k = upper(identifier)
    LEFT JOIN by_title t ON t.provider = asked.provider AND t.k = identifier
""")
def _(d: Data) -> DataFrame:
    by_id = d.orders.select(provider_of(F.col("o_custkey")), F.lower(flow_id_of(F.col("o_orderkey"))).alias("identifier"))
    by_structure = d.part.select(provider_of(F.col("p_partkey")), F.upper("p_brand").alias("identifier"))
    by_title = d.part.select(provider_of(F.col("p_size")), F.col("p_name").alias("identifier"))
    return catalog.resolve_dataflows(by_id.unionByName(by_structure).unionByName(by_title), d.flows)


@query("stale_links", """
    SELECT provider, df_id, scheme_id, cat_path FROM {links}
    WHERE (provider, df_id) NOT IN (SELECT (provider, df_id) FROM {flows} WHERE df_geo_dim IS NULL)
""")
def _(d: Data) -> DataFrame:
    return catalog.stale_links(d.links, d.flows.where("df_geo_dim IS NULL"))


@query("stale_link_counts", """
    SELECT count(*) FILTER ((provider, df_id) NOT IN (SELECT (provider, df_id) FROM {flows} WHERE df_geo_dim IS NULL)) AS n_stale,
           count(*) AS n_links FROM {links}
""")
def _(d: Data) -> DataFrame:
    return catalog.stale_link_counts(d.links, d.flows.where("df_geo_dim IS NULL"))


@query("provider_overview", """
    WITH p AS (SELECT p_type AS provider, p_type <> 'SMALL' AS categories_supported, max(p_size) AS n FROM {part}
               GROUP BY 1),
         c AS (SELECT provider, 100.0::DOUBLE * count(*) FILTER ((provider, df_id) IN (SELECT (provider, df_id) FROM {links}
                      WHERE scheme_id = 'ASIA')) / count(*) AS coverage FROM {flows} GROUP BY 1)
    SELECT provider, categories_supported, n, CASE WHEN categories_supported THEN round(coverage, 4) END AS coverage
    FROM p LEFT JOIN c USING (provider)
""")
def _(d: Data) -> DataFrame:
    supported = F.col("provider") != "SMALL"
    providers = d.part.groupBy(F.col("p_type").alias("provider")).agg(F.max("p_size").alias("n")).withColumn(
        "categories_supported", supported
    )
    coverage = catalog.catalog_coverage(d.flows, d.links.where("scheme_id = 'ASIA'"), ["provider"])
    return catalog.provider_overview(providers, coverage).withColumn("coverage", F.round("coverage", 4))


# --- aggregates over links and availability ----------------------------------


@query("available_codes", """
    SELECT DISTINCT 'GEO' AS dimension_id, GEO AS code_id FROM {obs}
    UNION SELECT 'SUPP', SUPP FROM {obs} UNION SELECT 'FLAG', FLAG FROM {obs}
    UNION SELECT 'STATUS', STATUS FROM {obs} UNION SELECT 'FREQ', FREQ FROM {obs}
""")
def _(d: Data) -> DataFrame:
    return codes.available_codes(d.obs, DIMS)


@query("available_codes_by_flow", "SELECT * FROM {avail}")
def _(d: Data) -> DataFrame:
    lines = d.lineitem.select(
        *flow_of("l_partkey"), F.col("l_returnflag").alias("FLAG"),
        F.col("l_linestatus").alias("STATUS"), F.col("l_suppkey").alias("SUPP"),
    )
    return codes.available_codes(lines, ["FLAG", "STATUS", "SUPP"], ["provider", "df_id"])


@query("constraint_summary", """
    WITH n AS (SELECT provider, df_id, dimension_id, count(DISTINCT code_id) AS n_values,
                      array_to_string(list_sort(list(DISTINCT code_id))[1:3], ', ') AS sample
               FROM {avail} GROUP BY ALL)
    SELECT provider, df_id, dimension_id, n_values, coalesce(sample, '') AS sample,
           CASE WHEN n_values IS NULL THEN 'missing' ELSE 'constraint' END AS source
    FROM (SELECT DISTINCT provider, df_id FROM {avail}) CROSS JOIN {dims_of_flows} LEFT JOIN n USING (provider, df_id, dimension_id)
""")
def _(d: Data) -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("FLAG", "STATUS", "SUPP", "GEO")])
    wanted = d.avail.select("provider", "df_id").distinct().select("provider", "df_id", F.explode(names).alias("dimension_id"))
    return codes.constraint_summary(wanted, d.avail, ["provider", "df_id"])


@query("merge_constraint_sets", """
    SELECT DISTINCT 'DF_' || l_partkey AS df_id, dimension_id, code_id FROM (
        SELECT l_partkey, unnest(['FLAG', 'STATUS', 'SUPP']) AS dimension_id,
               unnest([l_returnflag, l_linestatus, l_suppkey::VARCHAR]) AS code_id FROM {lineitem})
""")
def _(d: Data) -> DataFrame:
    from statcube.sources.messages_xml import merge_constraint_sets

    flow = F.concat(F.lit("DF_"), F.col("l_partkey").cast("string")).alias("df_id")
    per_line = d.lineitem.select(
        flow, F.inline(F.array(
            F.struct(F.lit("FLAG").alias("dimension_id"), F.col("l_returnflag").alias("code_id")),
            F.struct(F.lit("STATUS").alias("dimension_id"), F.col("l_linestatus").alias("code_id")),
            F.struct(F.lit("SUPP").alias("dimension_id"), F.col("l_suppkey").cast("string").alias("code_id")),
        ))
    )
    return merge_constraint_sets(per_line)


@query("category_context", """
    SELECT provider, df_id, string_agg(trim(coalesce(scheme_name, '') || ' ' || coalesce(cat_name, '')), ' '
                             ORDER BY scheme_id, cat_path) AS cat_context,
           min(trim(coalesce(cat_name, ''))) AS cat_primary
    FROM {links} LEFT JOIN (SELECT * FROM {categories} WHERE cat_id <> 'S3') c USING (scheme_id, cat_path)
    GROUP BY provider, df_id
""")
def _(d: Data) -> DataFrame:
    return catalog.category_context(d.links, d.categories.where("cat_id <> 'S3'"))


@query("dataflow_counts", """
    SELECT scheme_id, cat_path, count(DISTINCT (provider, df_id)) AS n_df FROM {links} GROUP BY ALL
""")
def _(d: Data) -> DataFrame:
    return catalog.dataflow_counts(d.links)


@query("scheme_counts", "SELECT scheme_id, count(DISTINCT (provider, df_id)) AS n_df FROM {links} GROUP BY ALL")
def _(d: Data) -> DataFrame:
    return catalog.scheme_counts(d.links)


@query("catalog_coverage", """
    SELECT provider, count(*) AS n_total, count(*) FILTER (hit) AS n_categorised,
           round(100.0::DOUBLE * count(*) FILTER (hit) / count(*), 4) AS coverage,
           cast(floor(100.0::DOUBLE * count(*) FILTER (hit) / count(*)) AS BIGINT) AS coverage_shown
    FROM (SELECT provider, (provider, df_id) IN (SELECT (provider, df_id) FROM {links} WHERE scheme_id = 'ASIA') AS hit FROM {flows})
    GROUP BY provider
""")
def _(d: Data) -> DataFrame:
    return catalog.catalog_coverage(d.flows, d.links.where("scheme_id = 'ASIA'"), ["provider"]).withColumn("coverage", F.round("coverage", 4))


@query("estimate_rows", """
    SELECT provider, df_id, product(n) * 83 AS max_rows, count(*) FILTER (n > 1) AS n_varied_dims,
           coalesce(string_agg(dimension_id, '+' ORDER BY dimension_id) FILTER (n > 1), '') AS varied_dims
    FROM (SELECT provider, df_id, dimension_id, count(DISTINCT code_id) AS n FROM {avail} GROUP BY ALL) GROUP BY provider, df_id
""")
def _(d: Data) -> DataFrame:
    return analyze.estimate_rows(d.avail, 83).withColumn("varied_dims", F.array_join("varied_dims", "+"))


@query("compose_title", """
    SELECT df_id, CASE WHEN t = '' OR c = '' THEN t || c WHEN starts_with(lower(t), lower(c)) THEN t
                       ELSE c || ' › ' || t END AS title
    FROM (SELECT df_id, trim(coalesce(df_description, '')) AS t,
                 trim(coalesce(CASE WHEN df_structure_id = 'Brand#3' THEN 'RED' ELSE df_structure_id END, '')) AS c
          FROM {flows})
""")
def _(d: Data) -> DataFrame:
    structure = F.col("df_structure_id")
    context = F.when(structure == "Brand#3", "RED").otherwise(structure)
    return d.flows.select("df_id", compose_title(F.col("df_description"), context).alias("title"))


# --- trees -------------------------------------------------------------------


@query("materialise_paths", """
    WITH RECURSIVE walk AS (
        SELECT scheme_id, id, cat_name, id AS cat_path, '' AS parent_path, 1 AS depth FROM {adjacency} WHERE parent IS NULL
        UNION ALL
        SELECT a.scheme_id, a.id, a.cat_name, w.cat_path || '.' || a.id, w.cat_path, w.depth + 1
        FROM {adjacency} a JOIN walk w ON a.scheme_id = w.scheme_id AND a.parent = w.id)
    SELECT scheme_id, id AS cat_id, cat_name, cat_path, parent_path, depth FROM walk
""")
def _(d: Data) -> DataFrame:
    return tree.materialise_paths(d.adjacency)


@query("materialise_paths_cycle", """
    WITH RECURSIVE walk AS (
        SELECT scheme_id, id, cat_name, id AS cat_path, '' AS parent_path, 1 AS depth FROM {adjacency} WHERE parent IS NULL
        UNION ALL
        SELECT a.scheme_id, a.id, a.cat_name, w.cat_path || '.' || a.id, w.cat_path, w.depth + 1
        FROM {adjacency} a JOIN walk w ON a.scheme_id = w.scheme_id AND a.parent = w.id)
    SELECT scheme_id, id AS cat_id, cat_name, cat_path, parent_path, depth FROM walk
""")
def _(d: Data) -> DataFrame:
    # The customers of a segment form a ring; a leaf hangs below each of them.
    ring = d.customer.select(
        F.lit("ASIA").alias("scheme_id"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
        F.lead("c_custkey").over(W.partitionBy("c_mktsegment").orderBy("c_custkey")).alias("_next"),
        F.min("c_custkey").over(W.partitionBy("c_mktsegment")).alias("_first"), F.col("c_name").alias("cat_name"))
    parent = F.concat(F.lit("C"), F.coalesce("_next", "_first").cast("string"))
    rings = ring.select("scheme_id", "id", parent.alias("parent"), "cat_name")
    lost = rings.select("scheme_id", F.concat(F.lit("L"), "id").alias("id"), F.col("id").alias("parent"), "cat_name")
    return tree.materialise_paths(d.adjacency.unionByName(rings).unionByName(lost))


@query("subtree", """
    SELECT scheme_id, cat_path, cat_name, depth FROM {categories}
    WHERE scheme_id = 'ASIA' AND (cat_path = 'NATION_2' OR starts_with(cat_path, 'NATION_2.'))
""")
def _(d: Data) -> DataFrame:
    return tree.subtree(d.categories, "ASIA", "NATION_2").select("scheme_id", "cat_path", "cat_name", "depth")


@query("limit_depth", """
    SELECT scheme_id, cat_path, depth, true AS below_root FROM {categories} WHERE depth <= 1 + 1
    UNION ALL SELECT scheme_id, cat_path, depth, false FROM {categories} WHERE depth <= 2 - 1
""")
def _(d: Data) -> DataFrame:
    columns = ["scheme_id", "cat_path", "depth"]
    below = tree.limit_depth(d.categories, 1, 1).select(*columns, F.lit(True).alias("below_root"))
    return below.unionByName(tree.limit_depth(d.categories, 2).select(*columns, F.lit(False).alias("below_root")))


@query("tree_rows", """
    SELECT scheme_id, cat_id, cat_path, cat_name, coalesce(cat_description, '') AS cat_description, parent_path, depth,
           coalesce(n_df, 0) AS n_df
    FROM {categories} LEFT JOIN (SELECT scheme_id, cat_path, count(DISTINCT (provider, df_id)) AS n_df FROM {links} GROUP BY ALL) n
      USING (scheme_id, cat_path)
""")
def _(d: Data) -> DataFrame:
    return tree.tree_rows(d.categories, d.links)


@query("scheme_rows", """
    SELECT scheme_id, scheme_name, coalesce(n_df, 0) AS n_df FROM (SELECT DISTINCT scheme_id, scheme_name
           FROM {categories}) LEFT JOIN (SELECT scheme_id, count(DISTINCT (provider, df_id)) AS n_df FROM {links} GROUP BY ALL) n
      USING (scheme_id)
""")
def _(d: Data) -> DataFrame:
    return tree.scheme_rows(d.categories, d.links)


# Values: nations are parents of suppliers; a negative balance makes a supplier a parent
# of the customers of its nation; everything else can be selected.
_VALUES_SQL = """
    SELECT r_name AS dimension_id, 'N' || n_nationkey AS id, n_name AS name, NULL AS parent, false AS is_selectable
    FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
    UNION ALL SELECT r_name, 'S' || s_suppkey, s_name, 'N' || s_nationkey, s_acctbal >= 0
    FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    UNION ALL SELECT r_name, 'C' || c_custkey, c_name, 'S' || s, true
    FROM {customer} JOIN (SELECT s_nationkey, min(s_suppkey) AS s FROM {supplier} GROUP BY 1) ON s_nationkey = c_nationkey
    JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""


def _hub_values(d: Data) -> DataFrame:
    place = d.nation.join(d.region, F.col("n_regionkey") == F.col("r_regionkey"))

    def key(letter: str, column: str):
        return F.concat(F.lit(letter), F.col(column).cast("string"))

    columns = ["dimension_id", "id", "name", "parent", "is_selectable"]
    nations = place.select(
        "r_name", key("N", "n_nationkey"), "n_name", F.lit(None).cast("string"), F.lit(False)
    ).toDF(*columns)
    suppliers = d.supplier.join(place, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "r_name", key("S", "s_suppkey"), "s_name", key("N", "s_nationkey"), F.col("s_acctbal") >= 0
    ).toDF(*columns)
    first = d.supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("s"))
    customers = (
        d.customer.join(first, F.col("s_nationkey") == F.col("c_nationkey"))
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("r_name", key("C", "c_custkey"), "c_name", key("S", "s"), F.lit(True)).toDF(*columns)
    )
    return nations.unionByName(suppliers).unionByName(customers)


@query("selectable_leaves", f"""
    WITH RECURSIVE v AS ({_VALUES_SQL}), walk AS (
        SELECT * FROM v WHERE parent IS NULL
        UNION SELECT v.* FROM v JOIN walk w ON v.dimension_id = w.dimension_id AND v.parent = w.id
        WHERE NOT w.is_selectable)
    SELECT DISTINCT dimension_id, id, name FROM walk WHERE is_selectable
""")
def _(d: Data) -> DataFrame:
    return tree.selectable_leaves(_hub_values(d))


@query("codelist_hierarchy", """
    SELECT id, name, parent, ord AS "order" FROM {codes} WHERE codelist_id IN ('CL_SUPP', 'CL_GEO') AND lang = 'en'
""")
def _(d: Data) -> DataFrame:
    return tree.codelist_hierarchy(d.codelists.where("codelist_id IN ('CL_SUPP', 'CL_GEO') AND lang = 'en'"))


@query("classify_category_or_dataflow", """
    WITH asked AS (SELECT @id(p_partkey) AS id FROM {part} UNION SELECT r_name FROM {region}
                   UNION SELECT n_name FROM {nation} UNION SELECT 'S' || s_suppkey FROM {supplier}
                   UNION SELECT p_name FROM {part}),
         c AS (SELECT cat_id AS id, bool_or(scheme_id = 'ASIA') AS here, min(scheme_id) AS other FROM {categories}
               GROUP BY 1),
         l AS (SELECT df_id AS id, min((scheme_id, cat_path)) FILTER (scheme_id = 'ASIA') AS here,
                      min((scheme_id, cat_path)) AS other FROM {links} GROUP BY 1)
    SELECT id, CASE WHEN id IN (SELECT scheme_id FROM {categories}) THEN 'scheme' WHEN c.here THEN 'category'
                    WHEN l.here IS NOT NULL THEN 'dataflow' WHEN l.other IS NOT NULL THEN 'dataflow_elsewhere'
                    WHEN c.other IS NOT NULL THEN 'category_elsewhere' ELSE 'unknown' END AS kind,
           CASE WHEN id IN (SELECT scheme_id FROM {categories}) THEN NULL WHEN c.here THEN 'ASIA'
                WHEN l.here IS NOT NULL THEN 'ASIA' WHEN l.other IS NOT NULL THEN l.other[1] ELSE c.other END AS scheme_id,
           CASE WHEN c.here THEN NULL ELSE split_part(coalesce(l.here, l.other)[2], '.', -1) END AS cat_id
    FROM asked LEFT JOIN c USING (id) LEFT JOIN l USING (id)
""")
def _(d: Data) -> DataFrame:
    def ids(df: DataFrame, column) -> DataFrame:
        return df.select(column.alias("id"))

    asked = ids(d.part, flow_id_of(F.col("p_partkey")))
    for more in (
        ids(d.region, F.col("r_name")), ids(d.nation, F.col("n_name")), ids(d.part, F.col("p_name")),
        ids(d.supplier, F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))),
    ):
        asked = asked.unionByName(more)
    return tree.classify_category_or_dataflow(asked, d.categories, d.links, "ASIA")
