import pytest
from pyspark.sql import functions as F

from conftest import of_provider
from statcube import session
from statcube.functions.text import compose_title
from statcube.operators import catalog, codes, labels, tree

CATEGORIES = [
    ("AGRI", "Agricoltura", "CROPS", "CROPS", "Coltivazioni", None, "", 1),
    ("AGRI", "Agricoltura", "CEREALS", "CROPS.CEREALS", "Cereali", None, "CROPS", 2),
    ("AGRI", "Agricoltura", "LIVESTOCK", "LIVESTOCK", "Allevamenti", None, "", 1),
]
LINKS = [
    ("WHEAT", "AGRI", "CROPS.CEREALS"), ("RICE", "AGRI", "CROPS.CEREALS"), ("OATS", "AGRI", "CROPS.CEREALS"),
    ("COWS", "AGRI", "LIVESTOCK"), ("WHEAT", "AGRI", "LIVESTOCK"),
]


@pytest.fixture(scope="module")
def cats(spark):
    return spark.createDataFrame(
        CATEGORIES, "scheme_id string, scheme_name string, cat_id string, cat_path string, cat_name string, "
        "cat_description string, parent_path string, depth int")


@pytest.fixture(scope="module")
def links(spark):
    return of_provider(spark.createDataFrame(LINKS, "df_id string, scheme_id string, cat_path string"))


@pytest.fixture(scope="module")
def flows(spark):
    return of_provider(spark.createDataFrame(
        [("WHEAT", "Wheat", "DSD_W"), ("RICE", None, "DSD_R"), ("COWS", "Cows", "DSD_C"), ("LONE", "Lone", None)],
        "df_id string, df_description string, df_structure_id string"))


def test_siblings(rows, cats, links, flows):
    one = catalog.siblings("P", "rice", links, cats, flows)
    assert rows(one, "df_id", "df_description", "is_target") == [
        ("OATS", "", False), ("RICE", "", True), ("WHEAT", "Wheat", False)]
    two = catalog.siblings("P", "WHEAT", links, cats, flows)
    assert rows(two.select("cat_path").distinct()) == [("CROPS.CEREALS",), ("LIVESTOCK",)]
    assert catalog.siblings("P", "NONE", links, cats, flows).count() == 0


def test_category_filter_multiplies_but_restriction_does_not(spark, rows, links, flows):
    for token, n in (("CEREALS", 3), ("CROPS.CEREALS", 3), ("NOPE", 0)):
        assert links.where(catalog.category_token(token)).count() == n
    twice = links.unionByName(spark.createDataFrame([("P", "WHEAT", "OTHER", "X.CEREALS")], links.schema))
    assert catalog.filter_by_category(flows, twice, "CEREALS").where("df_id = 'WHEAT'").count() == 2
    assert catalog.restrict_to_category(flows, twice, "CEREALS").where("df_id = 'WHEAT'").count() == 1


def test_context_takes_the_alphabetical_minimum_with_blanks(spark, rows, cats, links):
    broken = links.unionByName(spark.createDataFrame([("P", "COWS", "AGRI", "GONE")], links.schema))
    got = {r[1]: (r[2], r[3]) for r in catalog.category_context(broken, cats, include_scheme=False).collect()}
    assert got["WHEAT"] == ("Cereali Allevamenti", "Allevamenti")
    assert got["COWS"][1] == ""
    assert rows(catalog.category_context(links, cats).where("df_id = 'RICE'"), "cat_context") == [("Agricoltura Cereali",)]


@pytest.mark.parametrize(
    ("known", "linked", "share"), [("ABCD", "ABA", 50.0), ("AB", ["A", "B", "GONE"], 100.0), ("", "A", None)]
)
def test_coverage(spark, known, linked, share):
    flows = of_provider(spark.createDataFrame([(c,) for c in known], "df_id string"))
    links = of_provider(spark.createDataFrame([(c,) for c in linked], "df_id string"))
    assert catalog.catalog_coverage(flows, links).first()["coverage"] == share


def test_counts_are_direct_members(rows, cats, links):
    assert rows(tree.tree_rows(cats, links), "cat_path", "n_df") == [
        ("CROPS", 0), ("CROPS.CEREALS", 3), ("LIVESTOCK", 2)]
    assert rows(tree.scheme_rows(cats, links)) == [("AGRI", "Agricoltura", 4)]


def test_subtree_and_depth(rows, cats):
    assert rows(tree.subtree(cats, "AGRI", "CROPS"), "cat_path") == [("CROPS",), ("CROPS.CEREALS",)]
    assert rows(tree.limit_depth(cats, 2), "cat_path") == [("CROPS",), ("LIVESTOCK",)]
    assert tree.limit_depth(cats, 2, 0).count() == 3


def test_paths_of_a_deep_tree_and_a_cycle(spark, rows):
    chain = [("S", f"n{i}", f"n{i - 1}" if i else None) for i in range(21)]
    odd = [("S", "a", "b"), ("S", "b", "a"), ("S", "orphan", "missing"), ("T", "n1", None)]
    got = {(r["scheme_id"], r["cat_id"]): r for r in
           tree.materialise_paths(spark.createDataFrame(chain + odd, "scheme_id string, id string, parent string")).collect()}
    assert len(got) == 22
    deepest = got["S", "n20"]
    assert deepest["depth"] == 21 and deepest["cat_path"] == ".".join(f"n{i}" for i in range(21))
    assert deepest["parent_path"] == ".".join(f"n{i}" for i in range(20))
    assert got["T", "n1"]["cat_path"] == "n1" and got["T", "n1"]["parent_path"] == ""


def test_selectable_leaves_with_cycle(spark, rows):
    values = spark.createDataFrame(
        [("D", "root", "Root", None, False), ("D", "x", "X", "root", True), ("D", "sub", None, "root", False),
         ("D", "y", None, "sub", True), ("D", "root", "Root", "sub", False), ("D", "x", "X", "sub", True),
         ("D", "below_x", "no", "x", True)],
        "dimension_id string, id string, name string, parent string, is_selectable boolean")
    assert rows(tree.selectable_leaves(values)) == [("D", "x", "X"), ("D", "y", "")]


def test_resolve_by_id_structure_title(spark, rows, flows):
    asked = of_provider(spark.createDataFrame([("wheat",), ("dsd_r",), ("Cows",), ("cows!",)], "identifier string"))
    resolved = catalog.resolve_dataflows(asked, flows)
    # The catalog once, the identifiers three times.
    assert resolved._jdf.queryExecution().analyzed().toString().count("LogicalRDD") == 4
    assert rows(resolved, "identifier", "df_id") == [
        ("Cows", "COWS"), ("cows!", None), ("dsd_r", "RICE"), ("wheat", "WHEAT")]


def test_long_ids_and_constraint_flag(spark, rows):
    flows = of_provider(spark.createDataFrame([("22_289",), ("99_999",)], "df_id string"))
    longs = of_provider(spark.createDataFrame([("22_289_DF_DCIS_POPRES1_24",), ("7_DF_X",), ("99",)], "long_id string"))
    matched = catalog.match_catalog_ids(longs, flows)
    assert rows(matched, "long_id", "catalog_id") == [("22_289_DF_DCIS_POPRES1_24", "22_289"), ("7_DF_X", None), ("99", None)]
    assert rows(catalog.has_constraint_flag(flows, matched, True), "df_id", "has_constraint") == [("22_289", True), ("99_999", False)]
    assert rows(catalog.has_constraint_flag(flows, matched, False), "df_id", "has_constraint") == [("22_289", True), ("99_999", None)]


def test_unjudged_dimensions_have_no_invalid_codes(spark, rows):
    avail = spark.createDataFrame(
        [("P", "F", "geo", "IT"), ("P", "F", "unit", "RCH_A"), ("Q", "F", "geo", "XX"), ("P", "G", "age", "N")],
        "provider string, df_id string, dimension_id string, code_id string")
    got = catalog.invalid_codes(spark, {"GEO": "IT+XX", "age": "Y", "unit": "."}, avail, "P", "F")
    assert rows(got) == [("GEO", "XX")]


def test_classification_of_ids(spark, rows, cats, links):
    more = cats.unionByName(spark.createDataFrame([("ENV", "Env", "AIR", "AIR", "Air", None, "", 1)], cats.schema))
    asked = spark.createDataFrame([(i,) for i in ("AGRI", "CEREALS", "RICE", "AIR", "ZZ")], "id string")
    got = tree.classify_category_or_dataflow(asked, more, links, "AGRI")
    assert rows(got) == [
        ("AGRI", "scheme", None, None), ("AIR", "category_elsewhere", "ENV", None), ("CEREALS", "category", "AGRI", None),
        ("RICE", "dataflow", "AGRI", "CEREALS"), ("ZZ", "unknown", None, None)]
    elsewhere = tree.classify_category_or_dataflow(asked, more, links, "ENV").where("id = 'RICE'")
    assert rows(elsewhere) == [("RICE", "dataflow_elsewhere", "AGRI", "CEREALS")]


def test_stale_links(spark, rows, links, flows):
    assert rows(catalog.stale_links(links, flows), "df_id") == [("OATS",)]
    assert rows(catalog.stale_link_counts(links, flows)) == [(1, 5)]


def test_summary_of_missing_dimensions(spark, rows):
    dims = spark.createDataFrame([("geo", 1), ("unit", 2)], "dimension_id string, position int")
    avail = spark.createDataFrame([("geo", c) for c in "DBCA"], "dimension_id string, code_id string")
    assert rows(codes.constraint_summary(dims, avail)) == [
        ("geo", 1, 4, "A, B, C", "constraint"), ("unit", 2, None, "", "missing")]


@pytest.mark.parametrize(
    ("title", "category", "shown"),
    [
        ("Sesso, età", "Disoccupati - dati mensili", "Disoccupati - dati mensili › Sesso, età"),
        ("Consumer prices - annual", "Consumer prices", "Consumer prices - annual"),
        ("Average earnings", "Age", "Age › Average earnings"),
        ("ÈTA e sesso", "Età", "Età › ÈTA e sesso"),
        ("Età e sesso", "ETÀ", "Età e sesso"),
        ("Title", None, "Title"), ("", "Lavoro", "Lavoro"), (None, None, ""),
    ],
)
def test_titles(spark, title, category, shown):
    df = spark.createDataFrame([(title, category)], "t string, c string")
    assert df.select(compose_title(F.col("t"), F.col("c"))).first()[0] == shown


# --- providers ------------------------------------------------------------------


def test_two_providers_with_one_id_stay_apart(spark, rows):
    """Each operator on dataflows gives every provider its own rows."""
    flows = spark.createDataFrame([("A", "X", "a", "SA"), ("B", "X", "b", "SB"), ("B", "Y", "y", "SA")],
                                  "provider string, df_id string, df_description string, df_structure_id string")
    links = spark.createDataFrame([("A", "X", "S", "PRICES"), ("B", "X", "S", "FISH"), ("B", "Y", "S", "PRICES")],
                                  "provider string, df_id string, scheme_id string, cat_path string")
    cats = spark.createDataFrame([("S", "Scheme", "PRICES", "Prices"), ("S", "Scheme", "FISH", "Fish")],
                                 "scheme_id string, scheme_name string, cat_path string, cat_name string")
    context = catalog.category_context(links, cats)
    named = catalog.with_category_context(flows, context)
    assert rows(named, "provider", "df_id", "cat_context") == [("A", "X", "Scheme Prices"), ("B", "X", "Scheme Fish"), ("B", "Y", "Scheme Prices")]
    assert rows(catalog.siblings("A", "x", links, cats, flows), "provider", "df_id") == [("A", "X")]
    assert rows(catalog.category_dataflows(links, cats.where("cat_path = 'PRICES'"), flows), "provider", "df_description") == [("A", "a"), ("B", "y")]
    asked = spark.createDataFrame([("A", "x"), ("B", "x"), ("A", "sb"), ("B", "sb"), ("A", "y")], "provider string, identifier string")
    assert rows(catalog.resolve_dataflows(asked, flows)) == [("A", "sb", None), ("A", "x", "X"), ("A", "y", None), ("B", "sb", "X"), ("B", "x", "X")]
    assert rows(catalog.dataflow_counts(links), "cat_path", "n_df") == [("FISH", 1), ("PRICES", 2)]
    assert rows(catalog.scheme_counts(links)) == [("S", 3)]
    matched = catalog.match_catalog_ids(spark.createDataFrame([("A", "Y_DF_Z"), ("B", "Y_DF_Z")], "provider string, long_id string"), flows)
    assert rows(matched, "provider", "catalog_id") == [("A", None), ("B", "Y")]
    assert rows(catalog.has_constraint_flag(flows, matched, True), "provider", "df_id", "has_constraint") == [
        ("A", "X", False), ("B", "X", False), ("B", "Y", True)]
    dims = spark.createDataFrame([("SA", "geo", 1, None)], "structure_id string, dimension_id string, position int, codelist_id string")
    info = spark.createDataFrame([], "codelist_id string, description string")
    assert rows(labels.dimensions_info(flows, dims, info), "provider", "df_id", "dimension_id") == [("A", "X", "geo"), ("B", "Y", "geo")]


def test_a_table_without_provider_is_an_error(spark, flows, links):
    for call in (
        lambda: catalog.with_category_context(flows.drop("provider"), links), lambda: catalog.dataflow_counts(links.drop("provider")),
        lambda: catalog.stale_links(links, flows.drop("provider")),
    ):
        with pytest.raises(ValueError, match="has no provider"):
            call()


# --- trees and labels at size --------------------------------------------------


def test_a_cycle_takes_the_rounds_of_the_tree(spark, monkeypatch):
    """20,001 nodes in a ring beside a tree of three levels."""
    ring = spark.range(20_001).selectExpr("'S' AS scheme_id", "concat('c', id) AS id", "concat('c', (id + 1) % 20001) AS parent")
    chain = spark.createDataFrame([("S", "a", None), ("S", "b", "a"), ("S", "c", "b"), ("S", "lost", "c7")], ring.schema)
    cuts = []
    monkeypatch.setattr(tree, "cut_lineage", lambda df: cuts.append(1) or session.cut_lineage(df))
    got = tree.materialise_paths(ring.unionByName(chain)).collect()
    assert sorted((r["cat_path"], r["depth"], r["parent_path"]) for r in got) == [("a", 1, ""), ("a.b", 2, "a"), ("a.b.c", 3, "a.b")]
    assert len(cuts) <= 6


def test_long_codelist_tables_leave_the_cube_where_it_is(spark, rows):
    """A codelist table beyond the planner's broadcast limit, of which two short lists are needed."""
    filler = spark.range(120_000).selectExpr(
        "concat('CL_', id % 50) AS codelist_id", "'en' AS lang", "cast(id AS string) AS id", "repeat(cast(id AS string), 15) AS name",
        "cast(null AS string) AS parent", "id AS order")
    wanted = spark.createDataFrame([("GEO", "en", "1", "one", None, 1), ("SEX", "en", "T", "total", None, 1), ("SEX", "it", "T", "totale", None, 2)],
                                   "codelist_id string, lang string, id string, name string, parent string, order long")
    cube = spark.range(50).selectExpr("cast(id % 3 AS string) AS geo", "CASE WHEN id >= 0 THEN 'T' END AS sex", "cast(id AS double) AS OBS_VALUE")
    named = labels.enrich_labels(cube, {"GEO": "GEO", "SEX": "SEX", "NONE": "X"}, filler.unionByName(wanted), "en")
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") >= 2
    assert named.columns == ["geo", "sex", "OBS_VALUE", "geo_label", "sex_label"]
    assert rows(named.groupBy("geo", "geo_label", "sex_label").count()) == [("0", None, "total", 17), ("1", "one", "total", 17), ("2", None, "total", 16)]


def test_a_list_beyond_the_limit_is_joined_by_a_shuffle(spark, rows, monkeypatch):
    monkeypatch.setattr(labels, "BROADCAST_BYTES", 150)
    lists = spark.createDataFrame([("G", "1", "one"), ("S", "T", "total"), ("S", "M", "men")], "codelist_id string, id string, name string")
    cube = spark.createDataFrame([("1", "T"), ("2", "M"), (None, None)], "g string, s string")
    assert rows(labels.enrich_labels(cube, {"g": "G", "s": "S"}, lists)) == [
        (None, None, None, None), ("1", "T", "one", "total"), ("2", "M", None, "men")]


def test_estimates_name_the_varied_dimensions(spark, rows):
    from statcube.operators.analyze import estimate_rows

    avail = spark.createDataFrame([("P", "F", "geo", c) for c in "abc"] + [("P", "F", "sex", "T"), ("Q", "F", "sex", "M"), ("Q", "F", "sex", "F")],
                                  "provider string, df_id string, dimension_id string, code_id string")
    assert rows(estimate_rows(avail, 10)) == [("P", "F", 30.0, 1, ["geo"]), ("Q", "F", 20.0, 1, ["sex"])]
