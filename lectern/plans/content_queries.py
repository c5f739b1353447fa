"""Content documents, tokens, TF-IDF, SVD."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text
from lectern.operators import content as ops, svd
from lectern.plans.inputs import Inputs, query, r6, rounded
from lectern.plans.popularity_queries import POPULARITY_SQL, observed

MIN_DF, MAX_DF, MAX_FEATURES = 5, 0.98, 5000
TOKENS = r"regexp_extract_all(strip_accents(lower(COALESCE({0}, ''))), '[\p{{L}}\p{{N}}_](?:[\p{{L}}\p{{N}}_-]*[\p{{L}}\p{{N}}_])')"

CONTENT_SQL = {
    **POPULARITY_SQL,
    "texts": """SELECT book_id, interaction_book_id AS item_id, title, primary_author, genre_names, language_code,
        publication_year, interaction_count, CONCAT_WS(' ', COALESCE(title, ''), COALESCE(title, ''), COALESCE(title, ''),
        COALESCE(primary_author, ''), COALESCE(primary_author, ''), COALESCE(genre_names, ''), COALESCE(genre_names, ''),
        CASE WHEN LENGTH(description) >= 40 THEN description ELSE '' END,
        COALESCE('language_' || LOWER(language_code), ''),
        CASE WHEN publication_year BETWEEN 1000 AND 2100 THEN 'decade_' || CAST(publication_year // 10 * 10 AS VARCHAR) ELSE '' END
        ) AS content_text FROM documents_v JOIN observed ON interaction_book_id = item_id
        WHERE is_canonical_edition AND TRIM(title) <> ''""",
    "tokens": f"SELECT book_id, {TOKENS.format('content_text')} AS words FROM texts",
    "terms": """SELECT book_id, term, COUNT(*) AS tf FROM (SELECT book_id, UNNEST(words) AS term FROM tokens
        UNION ALL SELECT book_id, UNNEST(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM tokens
        WHERE len(words) > 1) GROUP BY book_id, term""",
    "stats": "SELECT term, CAST(SUM(tf) AS BIGINT) AS corpus_frequency, COUNT(*) AS document_frequency FROM terms GROUP BY term",
    "vocabulary": f"""SELECT term, corpus_frequency, document_frequency,
        LN((1.0 + n) / (1.0 + document_frequency)) + 1 AS idf FROM (SELECT *, ROW_NUMBER() OVER (
        ORDER BY corpus_frequency DESC, term) AS rn FROM stats, (SELECT COUNT(*) AS n FROM texts)
        WHERE document_frequency >= {MIN_DF} AND document_frequency <= {MAX_DF} * n) WHERE rn <= {MAX_FEATURES}""",
    "weights": """SELECT book_id, term, raw / SQRT(SUM(raw * raw) OVER (PARTITION BY book_id)) AS weight
        FROM (SELECT book_id, term, (1 + LN(tf)) * idf AS raw FROM terms JOIN vocabulary USING (term))""",
}


def documents(inp: Inputs):
    return ops.content_text(ops.content_docs_join(inp.view("documents_v"), observed(inp)))


def model(inp: Inputs, docs):
    return ops.tfidf_fit(docs, MAX_FEATURES, MIN_DF, MAX_DF, sample="all")


def weighted(docs):
    return ops.tfidf_fit_transform(docs, MAX_FEATURES, MIN_DF, MAX_DF)


@query("content_docs_join", "SELECT book_id, item_id, title, primary_author, interaction_count FROM texts", CONTENT_SQL)
def content_docs_join(inp):
    joined = ops.content_docs_join(inp.view("documents_v"), observed(inp))
    return joined.select("book_id", "item_id", "title", "primary_author", "interaction_count")


@query("content_text", "SELECT book_id, content_text FROM texts", CONTENT_SQL)
def content_text(inp):
    return documents(inp).select("book_id", "content_text")


@query(
    "fit_sample",
    """SELECT book_id, content_text FROM texts WHERE LENGTH(TRIM(content_text)) > 0
    ORDER BY md5(CAST(book_id AS VARCHAR)), book_id LIMIT 100""",
    CONTENT_SQL,
)
def fit_sample(inp):
    return ops.fit_sample(documents(inp), 100)


@query("tokenize", f"SELECT doc_id, {TOKENS.format('text')} AS tokens FROM {{documents}}")
def tokenize(inp):
    return inp.table("documents").select("doc_id", text.tokenize("text").alias("tokens"))


@query("ngrams", "SELECT book_id, term, tf FROM terms", CONTENT_SQL)
def ngrams(inp):
    return ops.document_terms(documents(inp))


@query("term_stats", "SELECT * FROM stats", CONTENT_SQL)
def term_stats(inp):
    return ops.term_stats(ops.document_terms(documents(inp)))


@query("vocabulary", "SELECT term, corpus_frequency, document_frequency, ROUND(idf, 6) AS idf FROM vocabulary", CONTENT_SQL)
def vocabulary(inp):
    return rounded(model(inp, documents(inp)).vocabulary.drop("term_index"), "idf")


@query("tfidf", "SELECT book_id, term, ROUND(weight, 6) AS weight FROM weights", CONTENT_SQL)
def tfidf(inp):
    return weighted(documents(inp))[1].select("book_id", "term", r6("weight").alias("weight"))


@query(
    "matrix_density",
    """SELECT COUNT(*) AS nonzero_values, (SELECT COUNT(*) FROM texts) AS rows, (SELECT COUNT(*) FROM vocabulary) AS columns,
    ROUND(COUNT(*) / ((SELECT COUNT(*) FROM texts) * (SELECT COUNT(*) FROM vocabulary)), 6) AS density FROM weights""",
    CONTENT_SQL,
)
def matrix_density(inp):
    fitted, weights = weighted(documents(inp))
    return rounded(ops.matrix_density(weights, fitted.documents, fitted.vocabulary.count()), "density")


@query(
    "stratified_sample",
    """SELECT lang, rows, LEAST(base + CASE WHEN place <= 300 - CAST(SUM(base) OVER () AS BIGINT) THEN 1 ELSE 0 END, rows) AS sample_rows
    FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY share - base DESC, lang) AS place FROM (
    SELECT lang, rows, 300 * rows / SUM(rows) OVER () AS share, CAST(FLOOR(300 * rows / SUM(rows) OVER ()) AS BIGINT) AS base
    FROM (SELECT lang, COUNT(*) AS rows FROM {documents} GROUP BY lang)))""",
)
def stratified_sample(inp):
    docs = inp.table("documents")
    drawn = ops.stratified_sample(docs, "lang", "doc_id", 300).groupBy("lang").agg(F.count("*").alias("sample_rows"))
    return docs.groupBy("lang").agg(F.count("*").alias("rows")).join(drawn, "lang", "left").select(
        "lang", "rows", F.coalesce("sample_rows", F.lit(0)).alias("sample_rows")
    )


def embedded(inp: Inputs, k: int = 32):
    """(documents, TF-IDF model, SVD model, unit content vectors)."""
    docs = documents(inp)
    fitted, weights = weighted(docs)
    factors = svd.truncated_svd(weights, fitted.vocabulary.count(), k)
    return docs, fitted, factors, svd.svd_project(factors, weights)


@query(
    "truncated_svd",
    """SELECT CAST(UNNEST(range(32)) AS INT) AS component, TRUE AS descending, TRUE AS orthonormal, TRUE AS first_holds_the_mean,
    TRUE AS within_the_rows FROM (SELECT COUNT(DISTINCT book_id) AS n FROM weights) WHERE n > 32""",
    CONTENT_SQL,
)
def truncated_svd(inp):
    """Invariants of each component. The rows have unit length, so the squared values add up to the documents at most, and
    the first one holds at least the squared length of the rows' sum over the documents."""
    docs = documents(inp)
    fitted, weights = weighted(docs)
    factors = svd.truncated_svd(weights, fitted.vocabulary.count(), 32)
    rows = weights.agg(F.count_distinct("book_id")).first()[0]
    sums = weights.groupBy("term_index").agg(F.sum("weight").alias("s")).agg(F.sum(F.col("s") * F.col("s"))).first()[0]
    values, gram = factors.singular_values, factors.basis.T @ factors.basis
    held = [
        (i, bool(i == 0 or values[i] <= values[i - 1] + 1e-9), bool(abs(gram[i, :i + 1] - [*[0.0] * i, 1.0]).max() < 1e-6),
         bool(values[0] ** 2 >= sums / rows - 1e-6), bool((values[:i + 1] ** 2).sum() <= rows + 1e-6))
        for i in range(len(values))
    ]
    return inp.spark.createDataFrame(held, "component int, descending boolean, orthonormal boolean, first_holds_the_mean boolean, within_the_rows boolean")


@query("explained_variance", "SELECT COUNT(DISTINCT book_id) AS documents, TRUE AS in_range FROM weights", CONTENT_SQL)
def explained_variance(inp):
    _, _, factors, vectors = embedded(inp)
    share = svd.explained_variance(factors)
    return vectors.agg(F.count("*").alias("documents")).withColumn("in_range", F.lit(bool(0.0 < share <= 1.0)))


@query("svd_project", "SELECT DISTINCT book_id, CAST(32 AS INT) AS dimensions, 1.0::DOUBLE AS length FROM weights", CONTENT_SQL)
def svd_project(inp):
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    return embedded(inp)[3].select("book_id", F.size("vector").alias("dimensions"), F.round(F.sqrt(squares), 6).alias("length"))
