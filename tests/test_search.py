import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from statcube.functions.text import tokenize
from conftest import of_provider
from statcube.operators import index, search, semantic, vocabulary


def frame(spark, pairs):
    return of_provider(spark.createDataFrame(pairs, "df_id string, df_description string"))


CATALOG = [("UNEMP", "Unemployment rate by age"), ("BIRTHS", "Live births by region"), ("GDP", "Gross domestic product")]


@pytest.fixture(scope="module")
def catalog(spark):
    return frame(spark, CATALOG)


def found(df):
    return [r["df_id"] for r in df.collect()]


def test_tokens(spark):
    df = spark.createDataFrame([("UNE_RT_M",), ("151_914_DF_DCCV",), ("Età, sesso!",), (None,)], "t string")
    assert [r[0] for r in df.select(tokenize(F.col("t"))).collect()] == [
        ["une", "rt", "m"], ["151", "914", "df", "dccv"], ["età", "sesso"], []]


def test_all_words_else_any_word(catalog):
    assert found(search.search(catalog, "unemployment age")) == ["UNEMP"]
    assert "UNEMP" in found(search.search(catalog, "unemployment nonexistenttoken"))
    mixed = found(search.search(catalog, "births region gross"))
    assert set(mixed) == {"BIRTHS", "GDP"} and mixed[0] == "BIRTHS"
    assert found(search.search(catalog, "zzz qqq")) == []


def test_category_context_is_searched(spark, catalog):
    context = spark.createDataFrame([("GDP", "Unemployment monthly")], "df_id string, cat_context string")
    joined = catalog.join(context, "df_id", "left").withColumn("cat_context", F.coalesce("cat_context", F.lit("")))
    got = found(search.search(joined, "unemployment"))
    assert got[0] == "UNEMP" and "GDP" in got


def test_null_title_is_no_match(spark):
    df = frame(spark, [("ALPHA_BETA", None), ("ALPHA", "alpha")])
    assert found(search.search(df, "alpha beta missing"))[0] == "ALPHA_BETA"
    df = frame(spark, [("REPEATED", "alpha " * 20), ("COVERED", "alpha beta")])
    assert found(search.search(df, "alpha beta missing")) == ["COVERED", "REPEATED"]
    assert found(search.legacy_score(df, "alpha beta missing", coverage_first=True)) == ["COVERED", "REPEATED"]


def test_query_without_words(spark):
    df = frame(spark, [("GDP", "Gross [domestic] product"), ("UNEMP", "Unemployment")])
    got = search.search(df, "[").collect()
    assert [(r["df_id"], r["score"]) for r in got] == [("GDP", 1.0)]
    assert search.search(df, "").count() == 2


def scores(spark, texts, query, ids=None):
    ids = ids or [f"s{i}" for i in range(len(texts))]
    docs = of_provider(spark.createDataFrame(list(zip(ids, texts)), "df_id string, text string"))
    got = {r["df_id"]: r["score"] for r in search.bm25_search(docs, query).collect()}
    return [got.get(i, 0.0) for i in ids]


def test_relevance(spark):
    many = scores(spark, ["tasso di disoccupazione"] + ["tasso di occupazione"] * 50, "tasso di disoccupazione")
    assert many[0] > many[1]
    assert np.greater(*scores(spark, ["unemployment rate", "unemployment " * 40], "unemployment rate"))
    prefix = scores(spark, ["dati comunali", "prezzi"], "comun")
    assert prefix[0] > 0 and prefix[1] == 0
    assert np.greater(*scores(spark, ["comun", "comunali"], "comun"))
    assert scores(spark, ["dati incomunicabile"], "comun") == [0.0]
    ids = ["EXPORT_ALPHA", "RT_ALPHA"]
    boosted = scores(spark, [f"alpha beta {i}" for i in ids], "alpha rt", ids)
    assert boosted[1] > boosted[0]


def test_empty_corpus(spark, tmp_path):
    docs = of_provider(spark.createDataFrame([], "df_id string, text string"))
    assert search.bm25_search(docs, "anything").count() == 0
    index.write_index(docs, str(tmp_path))
    empty = index.read_index(spark, str(tmp_path))
    assert index.corpus_size(empty).first() == (0, 1.0)
    assert index.bm25_score(empty, "anything").count() == 0 and index.bm25_top(empty, "anything", 3).count() == 0


def reference_scores(texts, ids, query):
    """The documented formula in plain Python, for brute force."""
    split = lambda t: re.findall(r"[^\W_]+", t.lower())
    docs = [split(t) for t in texts]
    counts = [Counter(d) for d in docs]
    average = sum(map(len, docs)) / len(docs) or 1.0
    holders = Counter(term for c in counts for term in c)
    weight_of = {t: math.log((len(docs) - n + 0.5) / (n + 0.5) + 1.0) for t, n in holders.items()}
    asked = split(query)
    reach = {q: {q} if q in holders else {t for t in holders if t.startswith(q)} for q in asked}
    pairs = [weight_of[t] for q in asked for t in reach[q]]
    unit = sum(pairs) / len(pairs) if pairs else 1.0
    result = []
    for text, tokens, count, name in zip(texts, docs, counts, ids):
        score = sum(
            (1.0 if q in holders else 0.5) * weight_of[t] * count[t] * 2.5
            / (count[t] + 1.5 * (0.25 + 0.75 * len(tokens) / average))
            for q in asked for t in reach[q] if t in count
        )
        if score > 0:
            in_id = sum(bool(reach[q] & set(split(name))) for q in asked)
            in_head = sum(bool(reach[q] & set(split(text[:60]))) for q in asked)
            score += unit * (3 * in_id + 2 * in_head) / len(asked)
        result.append(score)
    return result


WORDS = st.sampled_from(["ab", "abc", "abcd", "b", "ba", "x9", "long" * 12])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.lists(WORDS, max_size=12).map(" ".join), min_size=1, max_size=6),
    st.lists(st.sampled_from(["ab", "abc", "a", "b", "x", "zz", "lo"]), min_size=1, max_size=3).map(" ".join),
)
def test_scores_equal_brute_force(spark, texts, query):
    ids = [f"AB_{i}" for i in range(len(texts))]
    want = reference_scores(texts, ids, query)
    assert scores(spark, texts, query, ids) == pytest.approx(want)


def indexed(spark, path, pairs, provider="P"):
    docs = of_provider(spark.createDataFrame(pairs, "df_id string, text string"), provider)
    index.write_index(docs, str(path))
    return index.read_index(spark, str(path))


def test_stored_index_equals_direct_scoring(spark, rows, tmp_path):
    texts = ["alpha beta", "alpha alphabet", "", "gamma"]
    docs = of_provider(spark.createDataFrame([(f"D_{i}", t) for i, t in enumerate(texts)], "df_id string, text string"))
    stored = indexed(spark, tmp_path, [(f"D_{i}", t) for i, t in enumerate(texts)])
    direct = {r["df_id"]: r["score"] for r in search.bm25_search(docs, "alph beta d").collect()}
    got = {r["df_id"]: r["score"] for r in index.bm25_score(stored, "alph beta d").collect()}
    assert got == pytest.approx(direct) and index.corpus_size(stored).first()["n_docs"] == 4
    plan = index.bm25_score(stored, "alph")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(term,alph)" in plan


def test_counts_inside_a_row(spark, rows):
    docs = of_provider(spark.createDataFrame([("D_1", "b a b. B c"), ("X", None), ("Y_y", "!")], "df_id string, text string"))
    counted = index.postings(docs)
    assert rows(counted, "df_id", "doc_length", "term", "tf", "in_id", "in_head") == [
        ("D_1", 5, "1", 0, True, False), ("D_1", 5, "a", 1, False, True), ("D_1", 5, "b", 3, False, True),
        ("D_1", 5, "c", 1, False, True), ("D_1", 5, "d", 0, True, False), ("X", 0, "x", 0, True, False), ("Y_y", 0, "y", 0, True, False)]
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """600 texts of very different lengths over a few frequent and many rare words, by two providers."""
    rng = np.random.default_rng(5)
    vocabulary = ["ab", "abc", "abcd", "b", "ba", "c"] + [f"r{i}" for i in range(80)]
    share = np.array([20, 15, 10, 10, 5, 20] + [0.3] * 80)
    texts = [(f"P{i % 2}", f"D_{i - i % 2}", " ".join(rng.choice(vocabulary, int(rng.integers(0, 4) ** 3 * 2 + 1), p=share / share.sum())))
             for i in range(600)]
    path = str(tmp_path_factory.mktemp("index"))
    index.write_index(spark.createDataFrame(texts, "provider string, df_id string, text string").repartition(3), path)
    return index.read_index(spark, path)


@pytest.mark.parametrize("query", ["ab", "abc r5", "a b r", "r7 r8 r9", "d 10", "zzz", "abcd abcd ba"])
@pytest.mark.parametrize("provider", [None, "P1"])
def test_top_rows_are_those_of_the_full_ranking(many, query, provider, monkeypatch):
    monkeypatch.setattr(index, "FIRST_BLOCKS", 2)
    monkeypatch.setattr(index, "FEW_POSTINGS", 0)
    mine = many.of(provider)
    full = index.bm25_score(mine, query).orderBy(F.desc("score"), "provider", "df_id").limit(10).collect()
    top = index.bm25_top(mine, query, 10).collect()
    assert [(r["provider"], r["df_id"]) for r in top] == [(r["provider"], r["df_id"]) for r in full]
    assert [r["score"] for r in top] == pytest.approx([r["score"] for r in full])


def test_bounds_hold_and_skip_blocks(many):
    asked = index._ask(many, "abc r5")
    bounds = {r["block"]: r["bound"] for r in index.block_bounds(many, asked).collect()}
    assert asked.bounds == pytest.approx(bounds)
    blocks = many.postings.select("provider", "df_id", "block").distinct()
    best = index.bm25_score(many, "abc r5").join(blocks, ["provider", "df_id"]).groupBy("block").agg(F.max("score").alias("s"))
    scores = {r["block"]: r["s"] for r in best.collect()}
    assert all(scores[b] <= bounds[b] for b in scores)
    tenth = index.bm25_top(many, "abc r5", 10).collect()[-1]["score"]
    assert sum(bound >= tenth for bound in bounds.values()) < len(bounds)


def test_terms_beyond_the_drivers_limit_are_weighed_by_tasks(many, monkeypatch):
    want = {(r["provider"], r["df_id"]): r["score"] for r in index.bm25_score(many, "r a").collect()}
    monkeypatch.setattr(index, "LOCAL_ROWS", 3)
    monkeypatch.setattr(index, "FIRST_BLOCKS", 2)
    got = {(r["provider"], r["df_id"]): r["score"] for r in index.bm25_score(many, "r a").collect()}
    assert got == pytest.approx(want)
    best = sorted(want, key=lambda k: (-want[k], k))[:5]
    assert [(r["provider"], r["df_id"]) for r in index.bm25_top(many, "r a", 5).collect()] == best


def test_dictionary_gives_document_frequencies(many, rows):
    counted = many.postings.where("tf > 0").groupBy("term").agg(F.count("*").alias("df"))
    assert rows(index.bm25_stats(many), "term", "df") == rows(counted)


def test_one_id_of_two_providers_is_two_dataflows(spark, rows):
    both = of_provider(spark.createDataFrame([("X1", "apple prices")], "df_id string, df_description string"), "A").unionByName(
        of_provider(spark.createDataFrame([("X1", "banana prices")], "df_id string, df_description string"), "B"))
    assert rows(search.search(both, "prices"), "provider", "df_description") == [("A", "apple prices"), ("B", "banana prices")]
    vectors = both.select("provider", "df_id", F.when(F.col("provider") == "A", F.array(F.lit(1.0), F.lit(0.0))).otherwise(
        F.array(F.lit(0.0), F.lit(1.0))).cast("array<float>").alias("embedding"))
    queries = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.1, 1.0])], "query int, embedding array<double>")
    got = semantic.semantic_batch(vectors, queries, both, 5)
    assert rows(got, "query", "rank", "provider", "df_description") == [
        (1, 1, "A", "apple prices"), (1, 2, "B", "banana prices"), (2, 1, "B", "banana prices"), (2, 2, "A", "apple prices")]
    with pytest.raises(ValueError, match="provider"):
        search.search(both.drop("provider"), "prices")


# --- prefixes ---------------------------------------------------------------


def test_prefix_expansion_of_a_token_table(spark, rows):
    terms = spark.createDataFrame([("comuni",), ("comunali",), ("incomunicabile",), ("rate",)], "term string")
    tokens = spark.createDataFrame([("comun",), ("rate",), ("none",)], "token string")
    assert rows(vocabulary.expand_prefix(tokens, terms)) == [
        ("comun", "comunali", 0.5), ("comun", "comuni", 0.5), ("rate", "rate", 1.0)]


LETTERS = st.text("ab", min_size=0, max_size=5)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(LETTERS, max_size=8), st.lists(LETTERS, max_size=40), st.integers(1, 9))
def test_prefix_ranges_over_any_partitions(spark, rows, asked, known, parts):
    tokens = spark.createDataFrame([(t,) for t in asked], "token string")
    terms = spark.createDataFrame([(t,) for t in known], "term string").repartition(parts)
    want = []
    for token in {t for t in asked if t}:
        reached = {token} if token in known else {t for t in known if t.startswith(token)}
        want += [(token, t, 1.0 if t == token else 0.5) for t in reached]
    assert rows(vocabulary.expand_prefix(tokens, terms)) == sorted(want)


def test_a_range_over_many_partitions(spark, rows):
    """One token reaches 3,000 terms, dealt over the partitions, past a term of 5,000 characters."""
    terms = spark.range(3000).select(F.concat(F.lit("ab"), F.col("id").cast("string")).alias("term"))
    junk = spark.createDataFrame([("ab" + "q" * 5000,), ("b",)], "term string")
    tokens = spark.createDataFrame([("ab",), ("ab29",), ("ab2999",), ("b",), ("",), ("c",)], "token string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = vocabulary.expand_prefix(tokens, terms.unionByName(junk))
        assert got.rdd.getNumPartitions() > 1
        counts = {r["token"]: (r["n"], r["w"]) for r in got.groupBy("token").agg(F.count("*").alias("n"), F.max("weight").alias("w")).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert counts == {"ab": (3001, 0.5), "ab2999": (1, 1.0), "ab29": (1, 1.0), "b": (1, 1.0)}


# --- pages ------------------------------------------------------------------


def test_pages(catalog):
    page, total, cursor = search.paginate(catalog, 2, ["df_id"])
    assert ([r["df_id"] for r in page], total, cursor) == (["BIRTHS", "GDP"], 3, ("GDP",))
    page, total, cursor = search.paginate(catalog, 2, ["df_id"], cursor)
    assert ([r["df_id"] for r in page], total, cursor) == (["UNEMP"], 3, None)
    assert search.paginate(catalog, 2, ["df_id"], ("ZZZ",)) == ([], 3, None)
    assert search.paginate(catalog.limit(0), 2, ["df_id"]) == ([], 0, None)
    with pytest.raises(ValueError):
        search.paginate(catalog, 0, ["df_id"])
    with pytest.raises(ValueError):
        search.paginate(catalog, 2, ["df_id"], ("A", "B"))


@pytest.mark.parametrize("order", [["score", "df_id"], ["-score", "df_id"], ["-score", "-df_id"]])
def test_pages_cover_all_rows_once(spark, order):
    """Ties and nulls in the leading column; every page costs one pass with a top n."""
    data = [(None if i % 5 == 0 else i % 3, f"D{i:02d}") for i in range(23)]
    df = spark.createDataFrame(data, "score int, df_id string").repartition(3)
    cursor, pages = None, []
    while True:
        page, total, cursor = search.paginate(df, 4, order, cursor)
        assert total == 23
        pages += [tuple(r) for r in page]
        if cursor is None:
            break
    down, id_down = order[0].startswith("-"), order[1].startswith("-")
    by_id = sorted(data, key=lambda r: r[1], reverse=id_down)
    assert pages == sorted(by_id, key=lambda r: (r[0] is None, 0 if r[0] is None else -r[0] if down else r[0]))


def test_evaluation(spark):
    runs = spark.createDataFrame(
        [("a", 1, "X", 1), ("a", 1, "G1", 2), ("a", 2, "G2", 60), ("b", 3, "Q", 1)],
        "run string, query int, df_id string, rank int")
    runs, gold = of_provider(runs), of_provider(spark.createDataFrame([(1, "G1"), (1, "G9"), (2, "G2")], "query int, df_id string"))
    got = {r["run"]: (r["n_queries"], r["mrr"], r["success_at_k"]) for r in search.evaluate_ranking(runs, gold).collect()}
    assert got == {"a": (2, 0.25, 0.5), "b": (2, 0.0, 0.0)}
    fused = {(r["query"], r["df_id"]): r["score"] for r in search.rrf(runs).collect()}
    assert fused[1, "G1"] == pytest.approx(1 / 62)


# --- vectors -----------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    data = [(f"D{i:03d}", [float(x) for x in rng.normal(size=8)]) for i in range(200)]
    return data, of_provider(spark.createDataFrame(data, "df_id string, embedding array<float>")).repartition(5)


def brute_force(data, query, known, n):
    q = np.array(query) / (np.linalg.norm(query) + 1e-10)
    ranked = sorted(
        ((float(np.float32(v) @ q / (np.linalg.norm(np.float32(v)) + 1e-10)), i) for i, v in data),
        key=lambda p: (-p[0], p[1]),
    )
    return [i for _, i in ranked if i in known][:n]


@pytest.mark.parametrize("small", [False, True])
def test_nearest_equal_brute_force(spark, vectors, monkeypatch, small):
    if small:
        for name, value in (("BROADCAST_BYTES", 0), ("QUERY_ROWS", 2), ("VECTOR_ROWS", 16), ("GROUP", 3)):
            monkeypatch.setattr(semantic, name, value)
    data, df = vectors
    known = {i for i, _ in data if not i.endswith("3")}
    flows = frame(spark, [(i, f"title {i}") for i in sorted(known)])
    rng = np.random.default_rng(11)
    asked = {f"q{i}": [float(x) for x in rng.normal(size=8)] for i in range(9)}
    queries = spark.createDataFrame(list(asked.items()), "query string, embedding array<double>")
    got = semantic.semantic_batch(df, queries, flows, 6).orderBy("query", "rank").collect()
    for name, vector in asked.items():
        want = brute_force(data, vector, known, 6)
        assert [r["df_id"] for r in got if r["query"] == name] == want
        assert found(semantic.semantic_top_n(df, vector, flows, 6)) == want


def test_no_queries_no_rows(spark, vectors):
    queries = spark.createDataFrame([], "query string, embedding array<double>")
    flows = frame(spark, CATALOG)
    assert semantic.semantic_batch(vectors[1], queries, flows, 3).count() == 0


def test_embedding_text_and_vectors(spark, rows):
    flows = spark.createDataFrame([("A", "Title", "kw", ""), ("B", None, None, "note")],
                                  "df_id string, df_description string, df_keywords string, df_notes string")
    context = spark.createDataFrame([("A", "Cat")], "df_id string, cat_context string")
    prose = spark.createDataFrame([("B", "prose")], "df_id string, description string")
    texts = semantic.embedding_text(of_provider(flows), of_provider(context), of_provider(prose))
    assert rows(texts) == [("P", "A", "A Title Cat kw"), ("P", "B", "B prose note")]
    got = semantic.build_embeddings(texts, lambda batch: [[len(t), 1.0] for t in batch], batch=1)
    assert rows(got) == [("P", "A", [31.0, 1.0]), ("P", "B", [29.0, 1.0])]


def test_many_queries_stay_on_the_executors(spark, monkeypatch, rows):
    """Nothing of the queries but their number reaches the driver."""
    vectors = of_provider(spark.range(60).select(
        F.concat(F.lit("D"), F.col("id").cast("string")).alias("df_id"),
        F.array(F.cos(F.col("id").cast("double")), F.sin(F.col("id").cast("double"))).cast("array<float>").alias("embedding")))
    queries = spark.range(5000).select(F.col("id").alias("query"), F.array(F.cos(F.col("id") / 80.0), F.sin(F.col("id") / 80.0)).alias("embedding"))
    got = semantic.semantic_batch(vectors, queries, frame(spark, [(f"D{i}", "t") for i in range(60)]), 2)
    assert got.groupBy("query").count().where("count = 2").count() == 5000
    assert {r["df_id"] for r in got.where("query % 80 = 0 AND query < 4800 AND rank = 1").collect()} <= {f"D{i}" for i in range(60)}
    assert got.where("query = 800 AND rank = 1").first()["df_id"] == "D10"


def test_words_of_a_document_are_not_copied_into_its_postings(spark):
    docs = spark.createDataFrame([("P", "X1", "a b a")], "provider string, df_id string, text string")
    plan = index.postings(docs)._jdf.queryExecution().executedPlan().toString()
    exploded = next(line for line in plan.splitlines() if "Generate" in line)
    assert "_head_terms#" in exploded and not re.search(r"\b_terms#", exploded)


def test_dictionary_is_written_without_a_copy(spark, rows, tmp_path, monkeypatch):
    docs = spark.createDataFrame([("P", "X1", "a b a"), ("Q", "X1", "b c")], "provider string, df_id string, text string")
    monkeypatch.setattr(index, "cut_lineage", lambda df: pytest.fail("the dictionary is copied"))
    index.write_index(docs, str(tmp_path / "index"))
    stored = index.read_index(spark, str(tmp_path / "index"))
    assert rows(index.bm25_stats(stored), "term", "df") == [("a", 1), ("b", 2), ("c", 1)]
