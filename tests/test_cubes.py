from datetime import date

import pytest
from pyspark.sql import functions as F

from statcube.functions.text import base_code
from statcube.functions.timeperiod import parse_time_period, period_end
from statcube.model import CATALOG, CubeQuery
from statcube.operators import analyze, catalog, filters, labels, series, timeaxis
from statcube.plans.fetch import fetch, run_spec

PERIODS = {
    "2023": (date(2023, 1, 1), date(2023, 12, 31)),
    "2023-06": (date(2023, 6, 1), date(2023, 6, 30)),
    "2023-Q1": (date(2023, 1, 1), date(2023, 3, 31)),
    "2023-Q4": (date(2023, 10, 1), date(2023, 12, 31)),
    "2023-S1": (date(2023, 1, 1), date(2023, 6, 30)),
    "2023-S2": (date(2023, 7, 1), date(2023, 12, 31)),
    "2023-W01": (date(2023, 1, 1), date(2023, 1, 7)),
    "2023-W02": (date(2023, 1, 8), date(2023, 1, 14)),
    "2023-W00": (date(2022, 12, 25), date(2022, 12, 31)),
    "2023-06-15": (date(2023, 6, 15), date(2023, 6, 15)),
    " 2024-02\t": (date(2024, 2, 1), date(2024, 2, 29)),
    "2023-13": (None, None),
    "2023-02-30": (None, None),
    "2023-Q5": (None, None),
    "not-a-date": (None, None),
    **{odd: (None, None) for odd in (
        "2023-1", "2023-1-", "2023-1T", "12345-1", "12345-1-01", "2023-1-1T1", "2023-01-1T", "2023-W1", "2023-W+1",
        "2023-S3", "2023Q1", "20a3", "+2023", "-2023-1", "2023-01-01T00", "2023-W001", "2023-QQ", "", "2023/01",
    )},
    None: (None, None),
}


def test_periods(spark):
    df = spark.createDataFrame([(p,) for p in PERIODS], "p string")
    got = df.select("p", parse_time_period(F.col("p")), period_end(F.col("p"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == PERIODS


SERIES = [("IT", "T", str(y), float(y)) for y in range(2019, 2024)] + [("DE", "T", "2022", 1.0)]
DIMS = ["geo", "sex"]


@pytest.fixture(scope="module")
def cube(spark):
    return spark.createDataFrame(SERIES, "geo string, sex string, TIME_PERIOD string, OBS_VALUE double")


def test_ends_of_series(cube, rows):
    assert [r[2] for r in rows(series.last_n(cube, DIMS, 2))] == ["2022", "2022", "2023"]
    assert rows(series.first_n(cube, DIMS, 1), "geo", "TIME_PERIOD") == [("DE", "2022"), ("IT", "2019")]
    both = series.first_and_last_n(cube, DIMS, 1, 1)
    assert rows(both, "geo", "TIME_PERIOD") == [("DE", "2022"), ("IT", "2019"), ("IT", "2023")]


@pytest.mark.parametrize(("first", "last"), [(1, 1), (2, 2), (3, 2), (4, 4), (9, 9)])
def test_both_ends_equal_the_union_of_sets(cube, rows, first, last):
    wanted = set(rows(series.first_n(cube, DIMS, first))) | set(rows(series.last_n(cube, DIMS, last)))
    assert rows(series.first_and_last_n(cube, DIMS, first, last)) == sorted(wanted)


def test_salted_ranks_equal_plain_ranks(spark, rows, monkeypatch):
    cube = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("geo"),
        F.lpad(F.col("id").cast("string"), 6, "0").alias("TIME_PERIOD"), F.col("id").cast("double").alias("OBS_VALUE"),
    )
    plain = rows(series.last_n(cube, ["geo"], 700))
    monkeypatch.setattr(series, "PRUNED_BEFORE_SHUFFLE", 10)
    assert rows(series.last_n(cube, ["geo"], 700)) == plain


def test_rank_is_cut_before_the_shuffle(cube):
    plan = series.last_n(cube, DIMS, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_series_count_and_latest(cube, rows):
    assert rows(series.series_count(cube, DIMS)) == [(2, False)]
    assert rows(series.series_count(cube, DIMS, warn_above=1)) == [(2, True)]
    assert rows(series.latest_period(cube), "geo", "TIME_PERIOD") == [("IT", "2023")]
    assert rows(series.latest_per_entity(cube, ["geo"]), "geo", "TIME_PERIOD") == [("DE", "2022"), ("IT", "2023")]


def test_sort_puts_null_periods_first(spark):
    df = spark.createDataFrame([("2020-Q2", 6.8), ("bad", 1.0), ("2020-Q1", 7.5)], "TIME_PERIOD string, OBS_VALUE double")
    assert [r[1] for r in series.sort_by_time(timeaxis.with_dates(df)).collect()] == [1.0, 7.5, 6.8]


def test_filters(spark, rows):
    df = spark.createDataFrame(
        [("ITC4", "2021", 1.0), ("ITC1", "2021", 2.0), ("ITC4", "2020", 3.0), (None, "2021", 4.0)],
        "TERRITORIO string, TIME_PERIOD string, OBS_VALUE double",
    )
    one = filters.filter_period_year(filters.filter_dims(df, {"territorio": "ITC4"}), "2021-05", "2021")
    assert rows(one) == [("ITC4", "2021", 1.0)]
    assert filters.filter_dims(df, {"TERRITORIO": "."}).count() == 4
    many = {"TERRITORIO": [f"X{i}" for i in range(filters.INLINE_CODES)] + ["ITC1"]}
    assert rows(filters.filter_dims(df, many), "OBS_VALUE") == [(2.0,)]
    with pytest.raises(ValueError):
        filters.filter_dims(df, {"nowhere": "1"})


def test_period_window_is_exact(spark, rows):
    df = spark.createDataFrame([(p,) for p in ("2019-12", "2020-01", "2020-03", "2020-04", "bad")], "TIME_PERIOD string")
    assert rows(filters.filter_period(df, "2020", "2020-Q1")) == [("2020-01",), ("2020-03",)]
    assert rows(filters.filter_period(df, "2020-04")) == [("2020-04",)]
    assert rows(filters.filter_period(df, end="2019")) == [("2019-12",)]
    assert filters.filter_period(df, "2021", "2020").count() == 0
    with pytest.raises(ValueError):
        filters.filter_period(df, "yesterday")


def test_period_filter_reaches_the_scan(spark, tmp_path):
    spark.sql("SELECT DATE '2020-01-01' AS TIME_PERIOD, 'IT' AS geo, 1D AS OBS_VALUE").write.parquet(f"{tmp_path}/c")
    stored = spark.read.parquet(f"{tmp_path}/c")
    wanted = filters.filter_period(filters.filter_dims(stored, {"geo": "IT"}), "2020", "2020")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(TIME_PERIOD" in pushed and "EqualTo(geo,IT)" in pushed


def test_grep(spark, rows):
    df = spark.createDataFrame(
        [("AGRI_1", "Agriturismo - comuni"), ("PERM_2", "Permessi non comunitari"),
         ("BANK_3", "Servizi - dati comunali"), ("NULL_4", None)], "df_id string, df_description string")
    columns = ["df_id", "df_description"]
    assert rows(filters.grep(df, r"\bcomuni\b", columns), "df_id") == [("AGRI_1",)]
    assert rows(filters.grep(df, "bank", columns), "df_id") == [("BANK_3",)]
    with pytest.raises(ValueError):
        filters.grep(df, "[", columns)


def test_freshness(spark, rows):
    df = spark.createDataFrame(
        [("a", "2024-01-08"), ("a", "2024-01-01"), ("b", "2024-01-02"), ("b", "2024-01-08")], "k string, t string"
    ).selectExpr("k", "cast(t AS timestamp) AS cached_at")
    day = 86400
    assert rows(filters.fresh_only(df, ["k"], 7 * day, "2024-01-08").select("k").distinct()) == [("a",), ("b",)]
    assert rows(filters.fresh_only(df, ["k"], 7 * day, "2024-01-08", strict=True).select("k").distinct()) == [("b",)]
    young = df.where("cached_at > '2024-01-07'")
    first, second = filters.fresh_pair(df, young, ["k"], 7 * day, "2024-01-08")
    assert rows(first.select("k").distinct()) == [("b",)] and rows(second, "k") == [("b",)]


def test_conform_and_small_projections(spark, rows):
    df = spark.createDataFrame([("X", "T", "E")], "df_id string, version string, long string")
    conformed = filters.conform_schema(df, CATALOG)
    assert set(CATALOG.fieldNames()) <= set(conformed.columns)
    assert conformed.schema["has_constraint"].dataType.simpleString() == "boolean"
    assert rows(filters.group_key(df, ["df_id", "version"]), "group_key") == [("X_T",)]
    assert rows(filters.relabel(df, "long", {"E": "Short"}), "long") == [("Short",)]
    codes = spark.createDataFrame([("LBIRTH_FROM2017",), ("POP_1JAN2021",), ("DEATH",)], "c string")
    assert rows(codes.select(base_code(F.col("c")))) == [("DEATH",), ("LBIRTH",), ("POP_1JAN",)]


def test_exclude_aggregates_by_table(spark, rows, cube):
    totals = spark.createDataFrame([("geo", "DE")], "dimension_id string, code_id string")
    assert filters.exclude_aggregates(cube, totals).count() == 5


def test_exclude_aggregates_forms_agree(spark, rows):
    """A null code is no total, and no form moves a column."""
    df = spark.createDataFrame([("A", "DE"), ("A", None), ("A", "IT"), (None, "FR")], "freq string, geo string")
    table = spark.createDataFrame([("geo", "DE")], "dimension_id string, code_id string")
    want = {("A", None), ("A", "IT"), (None, "FR")}
    for totals in (table, {"geo": ["DE"]}):
        got = filters.exclude_aggregates(df, totals)
        assert got.columns == df.columns and {tuple(r) for r in got.collect()} == want


def test_filter_dims_alike_beyond_inline_codes(spark):
    df = spark.createDataFrame([("A", "1"), ("A", "x"), ("B", "998")], "freq string, geo string")
    for n in (999, 1000, 1001):
        got = filters.filter_dims(df, {"geo": [str(i) for i in range(n)]})
        assert got.columns == df.columns and sorted(map(tuple, got.collect())) == [("A", "1"), ("B", "998")]


def test_sort_by_time_spreads_one_period(spark):
    df = spark.range(20000).selectExpr("'2020' TIME_PERIOD", "cast(id as string) geo").repartition(4)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        got = series.sort_by_time(df).rdd.glom().map(len).collect()
    finally:
        spark.conf.unset(merging)
    assert sum(got) == 20000 and len([n for n in got if n]) > 1


def test_availability_of_one_dataflow(spark, rows):
    names = spark.createDataFrame([("IT", "Italy"), ("US", "States")], "id string, name string")
    avail = spark.createDataFrame([("P", "X", "geo", "IT"), ("P", "Y", "geo", "US"), ("Q", "X", "geo", "US")],
                                  "provider string, df_id string, dimension_id string, code_id string")
    assert rows(labels.values_in_dataflow(names, avail, "geo", "P", "X"), "id", "in_dataflow") == [("IT", True), ("US", False)]
    assert rows(labels.constraint_labels(avail, names, "geo", "P", "Y")) == [("US", "States")]
    assert rows(catalog.invalid_codes(spark, {"geo": "IT+US"}, avail, "P", "X")) == [("geo", "US")]


def test_membership_over_all_dataflows(spark, rows):
    names = spark.createDataFrame([("IT", "Italy"), ("US", "States"), ("ZZ", "None")], "id string, name string")
    avail = spark.createDataFrame([("P", "X", "geo", "IT"), ("P", "Y", "geo", "US"), ("Q", "X", "geo", "US")],
                                  "provider string, df_id string, dimension_id string, code_id string")
    values = labels.values_in_dataflow(names, avail, "geo")
    assert rows(values, "id", "in_dataflow") == [("IT", True), ("US", True), ("ZZ", False)]
    assert rows(labels.membership_counts(values)) == [(3, 2)]
    assert rows(catalog.invalid_codes(spark, {"geo": "IT+US+ZZ"}, avail)) == [("geo", "ZZ")]
    with pytest.raises(ValueError):
        labels.values_in_dataflow(names, avail, "geo", "P")


def test_two_providers_with_one_id_stay_apart(spark, rows):
    flows = spark.createDataFrame([("A", "X1", "apple"), ("B", "X1", "banana")], "provider string, df_id string, df_description string")
    links = spark.createDataFrame([("A", "X1", "S", "1.2")], "provider string, df_id string, scheme_id string, cat_path string")
    got = catalog.filter_by_category(flows, links, "2")
    assert rows(got, "provider", "df_description") == [("A", "apple")]
    assert rows(catalog.restrict_to_category(flows, links, "2"), "provider") == [("A",)]
    gone = spark.createDataFrame([("B", "X1", "S", "1.2")], links.schema)
    assert rows(catalog.stale_links(gone, flows.where("provider = 'A'")), "provider") == [("B",)]
    context = spark.createDataFrame([("A", "X1", "prices")], "provider string, df_id string, cat_context string")
    assert rows(catalog.with_category_context(flows, context), "provider", "cat_context") == [("A", "prices"), ("B", "")]


def test_result_page_without_tree(spark, rows):
    hits = spark.createDataFrame([("P", "A", None, 1.23456)], "provider string, df_id string, df_description string, score double")
    assert rows(filters.search_page_projection(hits)) == [("P", "A", "", "", 1.23)]


CODES = [
    ("CL_GEO", "en", "IT", "Italy", 1), ("CL_GEO", "en", "DE", "Germany", 2), ("CL_SEX", "en", "T", "Total", 1),
    ("CL_GEO", "it", "IT", "Italia", 1), ("CL_GEO", "en", "IT", "Italy (old)", 0),
]


@pytest.fixture(scope="module")
def codelists(spark):
    return spark.createDataFrame(CODES, "codelist_id string, lang string, id string, name string, order long")


def test_labels(spark, rows, codelists):
    obs = spark.createDataFrame(
        [("IT", "T", "2020", 1.0), ("DE", "T", "2020", 2.0), ("IT", "T", "2021", 3.0), ("ZZ", "T", "2021", 4.0)],
        "geo string, sex string, TIME_PERIOD string, OBS_VALUE double",
    )
    out = labels.enrich_labels(obs, {"GEO": "CL_GEO", "SEX": "CL_SEX", "TIME_PERIOD": None}, codelists, "en")
    assert out.columns == [*obs.columns, "geo_label", "sex_label"]
    assert rows(out, "OBS_VALUE", "geo_label", "sex_label") == [
        (1.0, "Italy", "Total"), (2.0, "Germany", "Total"), (3.0, "Italy", "Total"), (4.0, None, "Total")
    ]
    assert out.where("false").columns == out.columns


def test_filter_descriptions(spark, rows, codelists):
    got = labels.describe_filters(
        spark, {"geo": "IT", "sex": "T+F", "age": "Y"}, {"geo": "CL_GEO", "sex": "CL_SEX", "age": None},
        codelists.where("order > 0"), "en",
    )
    assert rows(got) == [("age", "Y", ""), ("geo", "IT", "Italy"), ("sex", "T+F", "")]


def test_membership_is_null_when_unknown(spark, rows):
    names = spark.createDataFrame([("IT", "Italy"), ("US", "States")], "id string, name string")
    avail = spark.createDataFrame([("P", "X", "NA_ITEM", "B1"), ("P", "X", "geo", "IT"), ("P", "Y", "SEX", "T")],
                                  "provider string, df_id string, dimension_id string, code_id string")
    assert rows(labels.values_in_dataflow(names, avail, "GEO", "P", "X"), "id", "in_dataflow") == [("IT", True), ("US", False)]
    unknown = labels.values_in_dataflow(names, avail, "SEX", "P", "X")
    assert rows(unknown, "in_dataflow") == [(None,), (None,)]
    assert rows(labels.membership_counts(unknown)) == [(2, 0)]
    assert rows(labels.constraint_labels(avail, names, "na-item", "P", "X")) == [("B1", "")]


def test_fetch_and_saved_query(spark, rows, cube, codelists):
    got = fetch(cube, CubeQuery("D", {"GEO": "IT"}, start="2020", end="2022", first_n=1, last_n=1), DIMS)
    assert [r["TIME_PERIOD"] for r in got.collect()] == [date(2020, 1, 1), date(2022, 1, 1)]
    spec = {"dataset": "D", "filters": {"geo": {"value": "DE"}}, "labels": True}
    out = run_spec(spec, {"D": cube}, {"geo": "CL_GEO", "sex": "CL_SEX"}, codelists, "en")
    assert rows(out, "geo_label", "sex_label", "OBS_VALUE") == [("Germany", "Total", 1.0)]
    with pytest.raises(KeyError):
        run_spec({"dataset": "GONE"}, {"D": cube}, {})


def test_axis_is_time_when_any_value_parses(spark, rows):
    df = spark.createDataFrame([("2020", "x"), ("later", "y")], "a string, b string")
    both = timeaxis.auto_parse_axis(timeaxis.auto_parse_axis(df, "a"), "b")
    assert rows(both, "a_date", "a_is_time", "b_is_time") == [(None, True, False), (date(2020, 1, 1), True, False)]


def test_flags_and_profile(spark, rows):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("e", None)], "OBS_FLAG string, OBS_VALUE double")
    assert rows(analyze.flag_legend(df, "OBS_FLAG")) == [("(absent)", 2, 0.6667, True), ("e", 1, 0.3333, True)]
    facts = {r["column_name"]: r for r in analyze.profile(df).collect()}
    assert (facts["OBS_VALUE"]["n_nulls"], facts["OBS_VALUE"]["n_distinct"], facts["OBS_VALUE"]["mean"]) == (1, 2, 1.5)
    assert facts["OBS_FLAG"]["n_distinct"] == 1 and facts["OBS_FLAG"]["mean"] is None
    assert analyze.profile(df, approximate=True).where("column_name = 'OBS_VALUE'").first()["n_distinct"] == 2
