"""Queries that find dataflows: keyword search, vectors, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from statcube.functions.text import tokenize
from statcube.operators import index, search, semantic, vocabulary
from statcube.operators.scoring import query_tokens
from workload.registry import Data, query
from workload.views import flow_of

WORD = r"([\p{L}\p{N}]+)"
# A common word, a rarer one, and a start that is no word itself.
QUERY = "the tion erst"
TEXT = "coalesce(df_description, '') || ' ' || df_id"


def bm25_sql(words: str, tail: str, docs: str | None = None) -> str:
    """The ranking in SQL: CTEs up to ``scored`` (provider, df_id, bm25, boost, score), then a tail."""
    asked = ", ".join(f"({i}, '{w}')" for i, w in enumerate(query_tokens(words)))
    n = len(query_tokens(words))
    docs = docs or f"SELECT provider, df_id, {TEXT} AS body FROM {{catalog}}"
    k = "provider, df_id"
    return f"""
    WITH docs AS ({docs}),
    tok AS (SELECT {k}, unnest(regexp_extract_all(lower(body), '{WORD}', 1)) AS term FROM docs),
    lens AS (SELECT {k}, count(term) AS dl FROM docs LEFT JOIN tok USING ({k}) GROUP BY ALL),
    size AS (SELECT count(*) AS n, avg(dl) AS a FROM lens),
    tf AS (SELECT {k}, term, count(*) AS tf FROM tok GROUP BY ALL),
    vocab AS (SELECT term, ln((n - count(*) + 0.5) / (count(*) + 0.5) + 1.0) AS idf FROM tf, size GROUP BY term, n),
    asked(pos, word) AS (VALUES {asked}),
    expanded AS (
        SELECT pos, term, idf, CASE WHEN term = word THEN 1.0 ELSE 0.5 END AS w
        FROM asked JOIN vocab ON starts_with(term, word)
        WHERE term = word OR word NOT IN (SELECT term FROM vocab)),
    unit AS (SELECT avg(idf) AS u FROM expanded),
    base AS (
        SELECT {k}, sum(w * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / a))) AS bm25
        FROM tf JOIN expanded USING (term) JOIN lens USING ({k}), size GROUP BY ALL),
    idt AS (SELECT DISTINCT {k}, unnest(regexp_extract_all(lower(df_id), '{WORD}', 1)) AS term FROM docs),
    headt AS (SELECT DISTINCT {k}, unnest(regexp_extract_all(lower(body[1:60]), '{WORD}', 1)) AS term FROM docs),
    idh AS (SELECT {k}, count(DISTINCT pos) AS h FROM idt JOIN expanded USING (term) GROUP BY ALL),
    headh AS (SELECT {k}, count(DISTINCT pos) AS h FROM headt JOIN expanded USING (term) GROUP BY ALL),
    scored AS (
        SELECT {k}, bm25, u * (3.0 * coalesce(idh.h, 0) + 2.0 * coalesce(headh.h, 0)) / {n} AS boost,
               bm25 + u * (3.0 * coalesce(idh.h, 0) + 2.0 * coalesce(headh.h, 0)) / {n} AS score
        FROM base LEFT JOIN idh USING ({k}) LEFT JOIN headh USING ({k}), unit WHERE bm25 > 0)
    {tail}
    """


def _texts(d: Data) -> DataFrame:
    return d.catalog.select("provider", "df_id", search.document_text(d.catalog).alias("text"))


def hits_sql(words: str, texts: list[str]) -> str:
    parts = [
        "(" + " OR ".join(f"contains(lower(coalesce({t}, '')), '{w}')" for t in texts) + ")::INT"
        for w in words.lower().split()
    ]
    return " + ".join(parts)


# --- keyword search ----------------------------------------------------------


@query("tokenize", f"""
    SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '{WORD}', 1)) AS term
                                     FROM {{documents}}) GROUP BY term
""")
def _(d: Data) -> DataFrame:
    words = d.documents.select(F.explode(tokenize(F.col("text"))).alias("term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query("candidates", f"""
    WITH h AS (SELECT provider, df_id, {hits_sql("there tion SRC1_", ["df_description", "df_id"])} AS n FROM {{catalog}})
    SELECT provider, df_id FROM h WHERE n = 3 OR (n > 0 AND (SELECT max(n) FROM h) < 3)
""")
def _(d: Data) -> DataFrame:
    return search.candidates(d.catalog, "there tion SRC1_").select("provider", "df_id")


@query("candidates_any_word", f"""
    WITH h AS (SELECT provider, df_id, {hits_sql("reti zzzyx", ["df_description", "df_id"])} AS n FROM {{catalog}})
    SELECT provider, df_id FROM h WHERE n = 2 OR (n > 0 AND (SELECT max(n) FROM h) < 2)
""")
def _(d: Data) -> DataFrame:
    return search.candidates(d.catalog, "reti zzzyx").select("provider", "df_id")


@query("literal_search", """
    SELECT provider, df_id, 1.0::DOUBLE AS score FROM {catalog} WHERE contains(df_description, '%%')
""")
def _(d: Data) -> DataFrame:
    return search.literal_search(d.catalog, "%%").select("provider", "df_id", "score")


def _index(d: Data, docs: DataFrame) -> index.Index:
    path = d.scratch("index")
    index.write_index(docs, path)
    return index.read_index(d.spark, path)


@query("bm25_stats", bm25_sql("the", """
    SELECT term, count(*) AS df, round(any_value(idf), 4) AS idf FROM tf JOIN vocab USING (term) GROUP BY term
"""))
def _(d: Data) -> DataFrame:
    return index.bm25_stats(_index(d, _texts(d))).withColumn("idf", F.round("idf", 4))


@query("postings", bm25_sql("the", """
    SELECT provider, df_id, term, dl::INT AS doc_length, coalesce(tf, 0)::INT AS tf, idt.term IS NOT NULL AS in_id,
           headt.term IS NOT NULL AS in_head
    FROM tf FULL JOIN idt USING (provider, df_id, term) FULL JOIN headt USING (provider, df_id, term)
    JOIN lens USING (provider, df_id)
"""))
def _(d: Data) -> DataFrame:
    return index.postings(_texts(d)).drop("block")


@query("dictionary", bm25_sql("the", """
    SELECT provider, term, count(tf) AS df, coalesce(max(tf), 0)::INT AS max_tf, coalesce(sum(tf), 0)::BIGINT AS words,
           coalesce(min(CASE WHEN tf > 0 THEN dl END), 0)::INT AS min_length,
           bool_or(idt.term IS NOT NULL) AS in_id, bool_or(headt.term IS NOT NULL) AS in_head
    FROM tf FULL JOIN idt USING (provider, df_id, term) FULL JOIN headt USING (provider, df_id, term)
    JOIN lens USING (provider, df_id) GROUP BY provider, term
"""))
def _(d: Data) -> DataFrame:
    # The blocks of a term put together.
    lengths = F.min(F.when(F.col("df") > 0, F.col("min_length")))
    return _index(d, _texts(d)).dictionary.groupBy("provider", "term").agg(
        F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"), F.sum("words").alias("words"),
        F.coalesce(lengths, F.lit(0)).alias("min_length"), F.max("in_id").alias("in_id"), F.max("in_head").alias("in_head"))


@query("corpus_size", bm25_sql("the", "SELECT n AS n_docs, round(a, 4) AS avg_length FROM size"))
def _(d: Data) -> DataFrame:
    return index.corpus_size(_index(d, _texts(d))).withColumn("avg_length", F.round("avg_length", 4))


@query("expand_prefix", f"""
    WITH vocab AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD}', 1)) AS term FROM {{documents}}),
    words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(p_name), '{WORD}', 1)) AS token FROM {{part}}
              UNION SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD}', 1)) FROM {{benchmark}})
    SELECT token, term, CASE WHEN token = term THEN 1.0 ELSE 0.5 END::DOUBLE AS weight
    FROM words JOIN vocab ON starts_with(term, token) WHERE token = term OR token NOT IN (SELECT term FROM vocab)
""")
def _(d: Data) -> DataFrame:
    def words(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.select(F.explode(tokenize(F.col(column))).alias(name))

    tokens = words(d.part, "p_name", "token").unionByName(words(d.benchmark, "text", "token"))
    return vocabulary.expand_prefix(tokens, words(d.documents, "text", "term"))


@query("bm25_score", bm25_sql(QUERY, """
    SELECT provider, df_id, round(bm25, 4) AS bm25, round(score, 4) AS score FROM scored
"""))
def _(d: Data) -> DataFrame:
    scored = index.bm25_score(_index(d, _texts(d)), QUERY)
    return scored.select("provider", "df_id", F.round("bm25", 4).alias("bm25"), F.round("score", 4).alias("score"))


@query("bm25_top", bm25_sql(QUERY, """
    SELECT provider, df_id, round(bm25, 4) AS bm25, round(score, 4) AS score FROM scored
    ORDER BY scored.score DESC, provider, df_id LIMIT 10
"""))
def _(d: Data) -> DataFrame:
    top = index.bm25_top(_index(d, _texts(d)), QUERY, 10)
    return top.select("provider", "df_id", F.round("bm25", 4).alias("bm25"), F.round("score", 4).alias("score"))


@query("bm25_top_of_provider", bm25_sql("erst wid the", """
    SELECT provider, df_id, round(bm25, 4) AS bm25, round(score, 4) AS score FROM scored
    ORDER BY scored.score DESC, provider, df_id LIMIT 25
""", f"SELECT provider, df_id, {TEXT} AS body FROM {{catalog}} WHERE provider = 'P1'"))
def _(d: Data) -> DataFrame:
    top = index.bm25_top(_index(d, _texts(d)).of("P1"), "erst wid the", 25)
    return top.select("provider", "df_id", F.round("bm25", 4).alias("bm25"), F.round("score", 4).alias("score"))


@query("field_boosts", bm25_sql(
    f"{QUERY} src1 the", "SELECT provider, df_id, round(boost, 4) AS boost, round(score, 4) AS score FROM scored"
))
def _(d: Data) -> DataFrame:
    scored = search.bm25_search(_texts(d), f"{QUERY} src1 the")
    return scored.select("provider", "df_id", F.round("boost", 4).alias("boost"), F.round("score", 4).alias("score"))


@query("search", bm25_sql(QUERY, f"""
    , h AS (SELECT provider, df_id, {hits_sql(QUERY, ["df_description", "df_id"])} AS n FROM {{catalog}})
    SELECT provider, df_id, df_structure_id, round(coalesce(score, 0), 4) AS score
    FROM h JOIN {{catalog}} USING (provider, df_id) LEFT JOIN scored USING (provider, df_id)
    WHERE n = 3 OR (n > 0 AND (SELECT max(n) FROM h) < 3)
"""))
def _(d: Data) -> DataFrame:
    found = search.search(d.catalog, QUERY)
    return found.select("provider", "df_id", "df_structure_id", F.round("score", 4).alias("score"))


_PARTS = "SELECT provider, df_id, coalesce(df_description, '') || ' ' || df_id || ' ' || coalesce(cat_context, '') AS body FROM found"


@query("search_with_context", bm25_sql("red 1996 wid", f"""
    , h AS (SELECT provider, df_id, {hits_sql("red 1996 wid", ["df_description", "df_id", "cat_context"])} AS n FROM found)
    SELECT provider, df_id, cat_context, round(coalesce(score, 0), 4) AS score
    FROM h JOIN found USING (provider, df_id) LEFT JOIN scored USING (provider, df_id)
    WHERE n = 3 OR (n > 0 AND (SELECT max(n) FROM h) < 3)
""", _PARTS).replace("WITH docs AS", """WITH found AS (
    SELECT provider, df_id, df_description, coalesce(cat_context, '') AS cat_context
    FROM {flows} LEFT JOIN {context} USING (provider, df_id)),
    docs AS""", 1))
def _(d: Data) -> DataFrame:
    from statcube.operators.catalog import with_category_context

    found = search.search(with_category_context(d.flows, d.context), "red 1996 wid")
    return found.select("provider", "df_id", "cat_context", F.round("score", 4).alias("score"))


def legacy_sql(words: str) -> str:
    t, i = "lower(coalesce(df_description, ''))", "lower(df_id)"
    parts = [
        f"3 * contains({i}, '{w}')::INT + 2 * contains({t}[1:60], '{w}')::INT"
        f" + cast(len(regexp_extract_all({t}, '{w}')) AS INT)"
        for w in words.lower().split()
    ]
    return " + ".join(parts)


@query("legacy_score", f"SELECT provider, df_id, cast({legacy_sql(QUERY)} AS INT) AS score FROM {{catalog}}")
def _(d: Data) -> DataFrame:
    return search.legacy_score(d.catalog, QUERY).select("provider", "df_id", "score")


@query("paginate", f"""
    SELECT provider, df_id, cast({legacy_sql(QUERY)} AS INT) AS score, (SELECT count(*) FROM {{catalog}}) AS n_found
    FROM {{catalog}} ORDER BY score DESC, df_id, provider LIMIT 25 OFFSET 50
""")
def _(d: Data) -> DataFrame:
    scored = search.legacy_score(d.catalog, QUERY).select("provider", "df_id", "score")
    cursor, page, total = None, [], 0
    for _ in range(3):
        page, total, cursor = search.paginate(scored, 25, ["-score", "df_id", "provider"], cursor)
    return d.spark.createDataFrame(page, scored.schema).withColumn("n_found", F.lit(total).cast("long"))


# --- vectors -----------------------------------------------------------------

DIM = 64
VECTOR = [((i * 7) % 11 - 5) / 10.0 for i in range(DIM)]
_VECTOR_SQL = "[" + ", ".join(str(x) for x in VECTOR) + "]::DOUBLE[]"
_COSINE = "list_dot_product(e, q) / ((sqrt(list_dot_product(e, e)) + 1e-10) * (sqrt(list_dot_product(q, q)) + 1e-10))"
# Queries: the mean vector of every label.
_CENTROIDS = """
    SELECT query, list(x ORDER BY i) AS q FROM (
        SELECT label AS query, i, avg(embedding[i]::DOUBLE) AS x FROM {embeddings}, range(1, 65) r(i) GROUP BY label, i)
    GROUP BY query
"""
_BATCH = f"""
    centroids AS ({_CENTROIDS}),
    near AS (SELECT query, provider, df_id, {_COSINE} AS score FROM centroids,
                    (SELECT provider, df_id, embedding::DOUBLE[] AS e FROM {{vectors}})),
    batch AS (SELECT query, provider, df_id, df_description, score,
                     row_number() OVER (PARTITION BY query ORDER BY score DESC, df_id, provider) AS rank
              FROM near JOIN {{vector_catalog}} USING (provider, df_id))
"""


def _queries(d: Data) -> DataFrame:
    places = d.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    means = places.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    return means.groupBy(F.col("label").alias("query")).agg(F.transform(ordered, lambda p: p["x"]).alias("embedding"))


@query("embedding_text", """
    SELECT provider, df_id, trim(concat_ws(' ', nullif(df_id, ''), nullif(df_description, ''), nullif(cat_context, ''),
                                 nullif(description, ''))) AS text
    FROM {flows} LEFT JOIN {context} USING (provider, df_id)
    LEFT JOIN (SELECT @flow(doc_id), CASE WHEN lang = 'de' THEN '' ELSE text END AS description
               FROM {documents}) p USING (provider, df_id)
""")
def _(d: Data) -> DataFrame:
    prose = d.documents.select(
        *flow_of("doc_id"),
        F.when(F.col("lang") == "de", "").otherwise(F.col("text")).alias("description"),
    )
    return semantic.embedding_text(d.flows, d.context, prose)


@query("build_embeddings", """
    SELECT provider, df_id, len(t)::FLOAT AS e0, (len(t) - len(replace(t, 'a', '')))::FLOAT AS e1,
           (len(t) - len(replace(t, ' ', '')))::FLOAT AS e2
    FROM (SELECT provider, df_id, 'search_document: ' || df_description AS t FROM {catalog})
""")
def _(d: Data) -> DataFrame:
    def letter_counts(texts: list[str]) -> list[list[float]]:
        """A stand-in model: counts of some characters."""
        return [[float(len(t)), float(t.count("a")), float(t.count(" "))] for t in texts]

    texts = d.catalog.select("provider", "df_id", F.col("df_description").alias("text"))
    vectors = semantic.build_embeddings(texts, letter_counts)
    return vectors.select("provider", "df_id", *[F.col("embedding")[i].alias(f"e{i}") for i in range(3)])


@query("semantic_top_n", f"""
    WITH near AS (SELECT provider, df_id, {_COSINE} AS score FROM (SELECT provider, df_id, embedding::DOUBLE[] AS e,
                  {_VECTOR_SQL} AS q FROM {{vectors}}) )
    SELECT provider, df_id, df_description, round(score, 4) AS score FROM near JOIN {{vector_catalog}} USING (provider, df_id)
    ORDER BY near.score DESC, df_id, provider LIMIT 20
""")
def _(d: Data) -> DataFrame:
    top = semantic.semantic_top_n(d.vectors, VECTOR, d.vector_catalog, 20)
    return top.withColumn("score", F.round("score", 4))


@query("semantic_batch", f"""
    WITH {_BATCH} SELECT query, provider, df_id, df_description, round(score, 4) AS score, rank::INT AS rank FROM batch
    WHERE rank <= 20
""")
def _(d: Data) -> DataFrame:
    batch = semantic.semantic_batch(d.vectors, _queries(d), d.vector_catalog, 20)
    return batch.withColumn("score", F.round("score", 4))


@query("min_score", f"""
    SELECT provider, df_id, round(score, 4) AS score FROM (SELECT provider, df_id, {_COSINE} AS score FROM (
        SELECT provider, df_id, embedding::DOUBLE[] AS e, {_VECTOR_SQL} AS q FROM {{vectors}})) WHERE score >= 0.1
""")
def _(d: Data) -> DataFrame:
    from statcube.functions.vectors import cosine, literal_vector

    scores = d.vectors.select("provider", "df_id", cosine(F.col("embedding"), literal_vector(VECTOR)).alias("score"))
    return semantic.min_score(scores, 0.1).withColumn("score", F.round("score", 4))


# Two runs to compare: vectors, and the same ranks turned around within a query.
_RUNS = f"""{_BATCH},
    top AS (SELECT * FROM batch WHERE rank <= 20),
    runs AS (SELECT 'vectors' AS run, query, provider, df_id, rank FROM top
             UNION ALL SELECT 'reversed', query, provider, df_id, max(rank) OVER (PARTITION BY query) + 1 - rank FROM top)
"""


def _runs(d: Data) -> DataFrame:
    top = semantic.semantic_batch(d.vectors, _queries(d), d.vector_catalog, 20).select("query", "provider", "df_id", "rank")
    last = F.max("rank").over(W.partitionBy("query"))
    plain = top.select(F.lit("vectors").alias("run"), "query", "provider", "df_id", "rank")
    turned = top.select(F.lit("reversed").alias("run"), "query", "provider", "df_id", (last + 1 - F.col("rank")).alias("rank"))
    return plain.unionByName(turned)


@query("evaluate_ranking", f"""
    WITH {_RUNS},
    gold AS (SELECT label AS query, provider, df_id FROM {{vectors}}),
    best AS (SELECT run, query, min(rank) AS r FROM runs JOIN gold USING (query, provider, df_id) WHERE rank <= 50 GROUP BY ALL),
    n AS (SELECT count(DISTINCT query) AS n FROM gold)
    SELECT run, n AS n_queries, round(sum(1.0::DOUBLE / r) / n, 4) AS mrr,
           round(count(*) FILTER (r <= 3) / n, 4) AS success_at_k
    FROM best, n GROUP BY run, n
""")
def _(d: Data) -> DataFrame:
    gold = d.vectors.select(F.col("label").alias("query"), "provider", "df_id")
    report = search.evaluate_ranking(_runs(d), gold, k=3)
    return report.withColumns({c: F.round(c, 4) for c in ("mrr", "success_at_k")})


@query("rrf", f"""
    WITH {_RUNS} SELECT query, provider, df_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM runs GROUP BY ALL
""")
def _(d: Data) -> DataFrame:
    return search.rrf(_runs(d)).withColumn("score", F.round("score", 6))
