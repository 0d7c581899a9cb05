"""Queries on cubes: filters, time, series, aggregates, whole reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from statcube.functions.text import base_code
from statcube.functions.timeperiod import parse_time_period
from statcube.model import CATALOG, CubeQuery
from statcube.operators import analyze, filters, series, timeaxis, tree
from statcube.plans.fetch import fetch, run_spec
from workload.registry import Data, query

DIMS = ["FREQ", "GEO", "SUPP", "FLAG", "STATUS"]
CODELISTS = {"GEO": "CL_GEO", "FLAG": "CL_FLAG", "STATUS": "CL_STATUS", "FREQ": None}
ALL = "FREQ, GEO, SUPP, FLAG, STATUS, TIME_PERIOD, OBS_VALUE"

# Short first day in SQL of the period forms of the ``periods`` view.
PERIOD_START = """
    CASE WHEN regexp_matches(p, '^[0-9]{4}$') THEN try_cast(p || '-01-01' AS DATE)
         WHEN regexp_matches(p, '^[0-9]{4}-[0-9]{2}$') THEN try_cast(p || '-01' AS DATE)
         WHEN regexp_matches(p, '^[0-9]{4}-Q[1-4]$')
              THEN make_date(cast(p[1:4] AS INT), 3 * cast(p[7:7] AS INT) - 2, 1)
         WHEN regexp_matches(p, '^[0-9]{4}-S[12]$')
              THEN make_date(cast(p[1:4] AS INT), 6 * cast(p[7:7] AS INT) - 5, 1)
         WHEN regexp_matches(p, '^[0-9]{4}-W[0-9]{2}$')
              THEN make_date(cast(p[1:4] AS INT), 1, 1) + 7 * (cast(p[7:8] AS INT) - 1)
         WHEN regexp_matches(p, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN try_cast(p AS DATE) END
"""
PERIOD_END = """
    CASE WHEN s IS NULL THEN NULL
         WHEN regexp_matches(p, '^[0-9]{4}$') THEN make_date(year(s), 12, 31)
         WHEN regexp_matches(p, '^[0-9]{4}-[0-9]{2}$') THEN last_day(s)
         WHEN regexp_matches(p, 'Q[1-4]$') THEN last_day(cast(s + INTERVAL 2 MONTH AS DATE))
         WHEN regexp_matches(p, 'S[12]$') THEN last_day(cast(s + INTERVAL 5 MONTH AS DATE))
         WHEN regexp_matches(p, 'W[0-9]{2}$') THEN s + 6 ELSE s END
"""


# --- filters -----------------------------------------------------------------


@query("filter_dims", f"SELECT {ALL} FROM {{obs}} WHERE FLAG IN ('A', 'N') AND GEO IN ('1', '5', '7')")
def _(d: Data) -> DataFrame:
    return filters.filter_dims(d.obs, [("flag", "A+N"), ("geo", "1"), ("GEO", ["5", "7"]), ("status", ".")], DIMS)


@query("filter_key", f"SELECT {ALL} FROM {{obs}} WHERE FREQ = 'M' AND FLAG IN ('A', 'R') AND STATUS = 'F'")
def _(d: Data) -> DataFrame:
    return filters.filter_key(d.obs, "M...A+R.F", DIMS)


@query(
    "filter_period",
    f"SELECT {ALL} FROM {{obs_dates}} WHERE TIME_PERIOD BETWEEN DATE '1996-01-01' AND DATE '1998-03-31'",
)
def _(d: Data) -> DataFrame:
    return filters.filter_period(d.obs_dates, "1996", "1998-Q1")


@query("filter_period_year", f"SELECT {ALL} FROM {{obs}} WHERE TIME_PERIOD[1:4] BETWEEN '1997' AND '1999'")
def _(d: Data) -> DataFrame:
    return filters.filter_period_year(d.obs, "1997-06", "1999-S1")


@query("grep", """
    SELECT df_id, df_structure_id FROM {catalog}
    WHERE regexp_matches(coalesce(df_description, ''), '(?i)\\bthe[rn]\\b')
       OR regexp_matches(df_structure_id, '(?i)\\bthe[rn]\\b')
""")
def _(d: Data) -> DataFrame:
    found = filters.grep(d.catalog, r"\bthe[rn]\b", ["df_description", "df_structure_id"])
    return found.select("df_id", "df_structure_id")


@query("exclude_blacklisted", """
    SELECT provider, df_id, df_description FROM {flows} ANTI JOIN {blacklist} USING (provider, df_id)
""")
def _(d: Data) -> DataFrame:
    return filters.exclude_blacklisted(d.flows, d.blacklist).select("provider", "df_id", "df_description")


@query("conform_schema", """
    SELECT df_id, version, df_geo_dim, cast(NULL AS BOOLEAN) AS has_constraint, cast(NULL AS VARCHAR) AS df_keywords,
           cast(NULL AS VARCHAR) AS df_notes FROM {flows}
""")
def _(d: Data) -> DataFrame:
    return filters.conform_schema(d.flows, CATALOG).select(
        "df_id", "version", "df_geo_dim", "has_constraint", "df_keywords", "df_notes"
    )


@query("fresh_only", """
    SELECT o_orderkey, o_custkey, o_orderdate FROM {orders} WHERE o_custkey IN (
        SELECT o_custkey FROM {orders} GROUP BY 1
        HAVING epoch(TIMESTAMP '2001-08-01') - epoch(min(o_orderdate)) <= 86400 * 1500)
""")
def _(d: Data) -> DataFrame:
    kept = filters.fresh_only(d.orders, ["o_custkey"], 86400 * 1500, "2001-08-01", "o_orderdate")
    return kept.select("o_orderkey", "o_custkey", "o_orderdate")


@query("fresh_pair", """
    WITH a AS (SELECT l_suppkey AS k, min(l_shipdate) AS t FROM {lineitem} GROUP BY 1),
         b AS (SELECT o_custkey AS k, min(o_orderdate) AS t FROM {orders} GROUP BY 1),
         young AS (SELECT a.k FROM a JOIN b USING (k)
                   WHERE epoch(TIMESTAMP '2001-08-01') - epoch(least(a.t, b.t)) < 86400 * 2400)
    SELECT o_orderkey, o_custkey AS k FROM {orders} WHERE o_custkey IN (SELECT k FROM young)
""")
def _(d: Data) -> DataFrame:
    first = d.lineitem.select(F.col("l_suppkey").alias("k"), F.col("l_shipdate").alias("cached_at"))
    second = d.orders.select("o_orderkey", F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("cached_at"))
    return filters.fresh_pair(first, second, ["k"], 86400 * 2400, "2001-08-01")[1].select("o_orderkey", "k")


@query("exclude_aggregates", f"""
    SELECT {ALL} FROM {{obs}} WHERE (GEO IS NULL OR GEO NOT IN ('0', '1')) AND (FLAG IS NULL OR FLAG <> 'R')
""")
def _(d: Data) -> DataFrame:
    return filters.exclude_aggregates(d.obs, {"GEO": ["0", "1"], "FLAG": ["R"]})


@query("split_unit", """
    SELECT GEO, SUPP, STATUS, strftime(TIME_PERIOD, '%Y') AS year, OBS_VALUE FROM {obs_dates} WHERE FLAG = 'N'
""")
def _(d: Data) -> DataFrame:
    return filters.split_unit(d.obs_dates, "N", "FLAG").select("GEO", "SUPP", "STATUS", "year", "OBS_VALUE")


@query("search_page_projection", """
    SELECT provider, df_id, coalesce(df_description, '') AS df_description, coalesce(cat_primary, '') AS category,
           round(len(df_id) / 7.0, 2) AS score
    FROM {flows} LEFT JOIN {context} USING (provider, df_id)
""")
def _(d: Data) -> DataFrame:
    hits = d.flows.join(d.context, ["provider", "df_id"], "left").withColumn("score", F.length("df_id") / 7.0)
    return filters.search_page_projection(hits)


@query("group_key", "SELECT GEO || '_' || FLAG AS group_key, SUPP, TIME_PERIOD, OBS_VALUE FROM {obs}")
def _(d: Data) -> DataFrame:
    return filters.group_key(d.obs, ["GEO", "FLAG"]).select("group_key", "SUPP", "TIME_PERIOD", "OBS_VALUE")


@query("relabel", """
    SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN 'STD' WHEN 'ECONOMY' THEN 'ECO' ELSE p_type END AS p_type
    FROM {part}
""")
def _(d: Data) -> DataFrame:
    return filters.relabel(d.part, "p_type", {"STANDARD": "STD", "ECONOMY": "ECO"}).select("p_partkey", "p_type")


@query("base_code", """
    WITH c AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'LBIRTH_FROM' || year(o_orderdate)
                    WHEN o_orderstatus = 'O' THEN 'POP_1JAN' || year(o_orderdate) ELSE o_orderpriority END AS code
               FROM {orders})
    SELECT o_orderkey, code, CASE WHEN code LIKE 'LBIRTH%' THEN 'LBIRTH' WHEN code LIKE 'POP%' THEN 'POP_1JAN'
                                  ELSE code END AS base FROM c
""")
def _(d: Data) -> DataFrame:
    year = F.year("o_orderdate").cast("string")
    code = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("LBIRTH_FROM"), year))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("POP_1JAN"), year)).otherwise(F.col("o_orderpriority"))
    )
    return d.orders.select("o_orderkey", code.alias("code"), base_code(code).alias("base"))


# --- time --------------------------------------------------------------------


@query("parse_time_period", f"""
    SELECT o_orderkey, period, {PERIOD_START} AS first_day FROM (SELECT *, trim(period) AS p FROM {{periods}})
""")
def _(d: Data) -> DataFrame:
    return d.periods.withColumn("first_day", parse_time_period(F.col("period")))


@query("period_bounds", f"""
    SELECT o_orderkey, period, s AS period_start, {PERIOD_END} AS period_end
    FROM (SELECT *, {PERIOD_START} AS s FROM (SELECT *, trim(period) AS p FROM {{periods}}))
""")
def _(d: Data) -> DataFrame:
    return timeaxis.period_bounds(d.periods, "period")


@query("year_string", "SELECT GEO, SUPP, FLAG, STATUS, TIME_PERIOD[1:4] AS TIME_PERIOD, OBS_VALUE FROM {obs}")
def _(d: Data) -> DataFrame:
    return timeaxis.year_string(d.obs).drop("FREQ")


@query("time_range", """
    SELECT min(TIME_PERIOD) AS first_period, max(TIME_PERIOD) AS last_period FROM {obs_dates} WHERE FLAG = 'A'
""")
def _(d: Data) -> DataFrame:
    return timeaxis.time_range(filters.filter_dims(d.obs_dates, {"FLAG": "A"}, DIMS))


@query("auto_parse_axis", f"""
    SELECT o_orderkey, {PERIOD_START} AS period_date, true AS period_is_time, NULL::DATE AS status_date,
           false AS status_is_time
    FROM (SELECT *, trim(period) AS p FROM {{periods}})
""")
def _(d: Data) -> DataFrame:
    both = timeaxis.auto_parse_axis(d.periods.withColumn("status", F.lit("open")), "period")
    return timeaxis.auto_parse_axis(both, "status").select(
        "o_orderkey", "period_date", "period_is_time", "status_date", "status_is_time"
    )


# --- series ------------------------------------------------------------------

_RANKS = f"""
    SELECT {ALL}, row_number() OVER (PARTITION BY GEO, SUPP, FLAG, STATUS ORDER BY TIME_PERIOD) AS a,
           row_number() OVER (PARTITION BY GEO, SUPP, FLAG, STATUS ORDER BY TIME_PERIOD DESC) AS z FROM {{obs}}
"""


@query("last_n", f"SELECT {ALL} FROM ({_RANKS}) WHERE z <= 3")
def _(d: Data) -> DataFrame:
    return series.last_n(d.obs, DIMS, 3)


@query("first_n", f"SELECT {ALL} FROM ({_RANKS}) WHERE a <= 2")
def _(d: Data) -> DataFrame:
    return series.first_n(d.obs, DIMS, 2)


@query("first_and_last_n", f"SELECT {ALL} FROM ({_RANKS}) WHERE a <= 30 OR z <= 20")
def _(d: Data) -> DataFrame:
    return series.first_and_last_n(d.obs, DIMS, 30, 20)


@query("series_count", """
    SELECT count(*) AS n_series, count(*) > 5000 AS is_large FROM (SELECT DISTINCT GEO, SUPP, FLAG, STATUS FROM {obs})
""")
def _(d: Data) -> DataFrame:
    return series.series_count(d.obs, DIMS)


@query("latest_period", f"SELECT {ALL} FROM {{obs}} WHERE TIME_PERIOD = (SELECT max(TIME_PERIOD) FROM {{obs}})")
def _(d: Data) -> DataFrame:
    return series.latest_period(d.obs)


@query("latest_per_entity", """
    SELECT EVENT, PERSON, TIME_PERIOD, OBS_VALUE FROM (
        SELECT *, row_number() OVER (PARTITION BY PERSON ORDER BY TIME_PERIOD DESC, EVENT DESC) AS z FROM {obs_daily})
    WHERE z = 1
""")
def _(d: Data) -> DataFrame:
    return series.latest_per_entity(d.obs_daily, ["PERSON"])


@query("sort_by_time", "SELECT EVENT, PERSON, TIME_PERIOD, OBS_VALUE FROM {obs_daily}")
def _(d: Data) -> DataFrame:
    return series.sort_by_time(d.obs_daily)


# --- aggregates --------------------------------------------------------------


@query("top_n_groups", f"""
    SELECT {ALL} FROM {{obs}} WHERE GEO IN (
        SELECT GEO FROM {{obs}} GROUP BY GEO ORDER BY sum(OBS_VALUE) DESC, GEO LIMIT 6)
""")
def _(d: Data) -> DataFrame:
    return analyze.top_n_groups(d.obs, "GEO", 6)


@query("category_order", "SELECT SUPP, sum(OBS_VALUE) AS total FROM {obs} GROUP BY SUPP")
def _(d: Data) -> DataFrame:
    return analyze.category_order(d.obs, "SUPP")


@query("flag_legend", """
    SELECT coalesce(nullif(l_returnflag, 'N'), '(absent)') AS flag, count(*) AS n_rows,
           round(count(*) / (SELECT count(*) FROM {lineitem}), 4) AS share,
           count(*) / (SELECT count(*) FROM {lineitem}) > 0.1 AS is_marked
    FROM {lineitem} GROUP BY 1
""")
def _(d: Data) -> DataFrame:
    rows = d.lineitem.select(F.nullif(F.col("l_returnflag"), F.lit("N")).alias("OBS_FLAG"))
    return analyze.flag_legend(rows, "OBS_FLAG")


@query("entity_coverage", """
    SELECT SUPP, count(DISTINCT TIME_PERIOD) AS n_periods, strftime(min(TIME_PERIOD), '%Y') AS first_year,
           strftime(max(TIME_PERIOD), '%Y') AS last_year
    FROM {obs_dates} GROUP BY SUPP
""")
def _(d: Data) -> DataFrame:
    return analyze.entity_coverage(d.obs_dates, "SUPP")


@query("code_frequency", """
    SELECT l_suppkey, count(*) AS n_rows FROM {lineitem} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30
""")
def _(d: Data) -> DataFrame:
    return analyze.code_frequency(d.lineitem, "l_suppkey", 30)


def _profile_sql(columns: list[tuple[str, bool]]) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,"
        f" cast(min({c}) AS VARCHAR) AS min_value, cast(max({c}) AS VARCHAR) AS max_value,"
        f" {f'round(avg({c}), 4)' if numeric else 'cast(NULL AS DOUBLE)'} AS mean,"
        f" count(DISTINCT {c}) AS n_distinct FROM {{obs}}"
        for c, numeric in columns
    ]
    return " UNION ALL ".join(parts)


@query("profile", _profile_sql([(c, c == "OBS_VALUE") for c in ALL.split(", ")]))
def _(d: Data) -> DataFrame:
    return analyze.profile(d.obs)


@query("pivot_wide", """
    SELECT GEO, SUPP, STATUS, TIME_PERIOD, max(CASE WHEN FLAG = 'A' THEN OBS_VALUE END) AS A,
           max(CASE WHEN FLAG = 'N' THEN OBS_VALUE END) AS N, max(CASE WHEN FLAG = 'R' THEN OBS_VALUE END) AS R
    FROM {obs} GROUP BY 1, 2, 3, 4
""")
def _(d: Data) -> DataFrame:
    return analyze.pivot_wide(d.obs, ["GEO", "SUPP", "STATUS", "TIME_PERIOD"], "FLAG", ["A", "N", "R"])


@query("join_cubes", """
    SELECT a.SUPP, a.TIME_PERIOD, a.v AS v_final, b.v AS v_open, round(a.v / b.v, 4) AS ratio
    FROM (SELECT SUPP, TIME_PERIOD, sum(OBS_VALUE) AS v FROM {obs} WHERE STATUS = 'F' GROUP BY 1, 2) a
    JOIN (SELECT SUPP, TIME_PERIOD, sum(OBS_VALUE) AS v FROM {obs} WHERE STATUS = 'O' GROUP BY 1, 2) b
      USING (SUPP, TIME_PERIOD)
""")
def _(d: Data) -> DataFrame:
    keys = ["SUPP", "TIME_PERIOD"]

    def cube(status: str, name: str) -> DataFrame:
        return d.obs.where(F.col("STATUS") == status).groupBy(*keys).agg(F.sum("OBS_VALUE").alias(name))

    ratio = F.round(F.col("v_final") / F.col("v_open"), 4)
    return analyze.join_cubes(cube("F", "v_final"), cube("O", "v_open"), keys, {"ratio": ratio})


@query("rollup_parent", """
    SELECT parent AS GEO, SUPP, FLAG, TIME_PERIOD, sum(OBS_VALUE) AS OBS_VALUE
    FROM {obs} JOIN (SELECT DISTINCT id, parent FROM {codes} WHERE codelist_id = 'CL_GEO' AND lang = 'en') c ON GEO = id
    WHERE parent IS NOT NULL GROUP BY ALL
""")
def _(d: Data) -> DataFrame:
    geo = d.codelists.where("codelist_id = 'CL_GEO' AND lang = 'en'")
    return tree.rollup_parent(d.obs.drop("FREQ", "STATUS"), "GEO", geo)


# --- whole reads -------------------------------------------------------------

_FETCH = """
    SELECT {cols}, cast(TIME_PERIOD || '-01' AS DATE) AS TIME_PERIOD FROM (
        SELECT *, row_number() OVER (PARTITION BY GEO, SUPP, FLAG, STATUS ORDER BY TIME_PERIOD DESC) AS z
        FROM {{obs}} WHERE FLAG IN ('A', 'N') AND TIME_PERIOD BETWEEN '1996-01' AND '1998-12')
    WHERE z <= 3
"""


@query("fetch", _FETCH.format(cols="FREQ, GEO, SUPP, FLAG, STATUS, OBS_VALUE").replace("{{", "{").replace("}}", "}"))
def _(d: Data) -> DataFrame:
    return fetch(d.obs, CubeQuery("SALES", {"flag": "A+N"}, start="1996", end="1998", last_n=3), DIMS)


@query("run_spec", f"""
    SELECT o.*, g.name AS GEO_label, f.name AS FLAG_label, s.name AS STATUS_label
    FROM ({_FETCH.format(cols="FREQ, GEO, SUPP, FLAG, STATUS, OBS_VALUE")}) o
    LEFT JOIN (SELECT id, name FROM {{codes}} WHERE codelist_id = 'CL_GEO' AND lang = 'en') g ON GEO = g.id
    LEFT JOIN (SELECT id, name FROM {{codes}} WHERE codelist_id = 'CL_FLAG') f ON FLAG = f.id
    LEFT JOIN (SELECT id, name FROM {{codes}} WHERE codelist_id = 'CL_STATUS') s ON STATUS = s.id
""")
def _(d: Data) -> DataFrame:
    spec = {
        "dataset": "SALES", "filters": {"FLAG": {"value": "A+N", "description": ""}},
        "start_period": "1996", "end_period": "1998", "last_n": 3, "labels": True,
    }
    dims = {"FREQ": None, "GEO": "CL_GEO", "SUPP": None, "FLAG": "CL_FLAG", "STATUS": "CL_STATUS"}
    return run_spec(spec, {"SALES": d.obs}, dims, d.codelists, "en")
