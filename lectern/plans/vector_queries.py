"""Vectors: norms, hybrids, neighbours, weighted sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import vectors as fn
from lectern.functions.scoring import library_preference_weight
from lectern.operators import collaborative, similarity as ops
from lectern.plans.graph_queries import training
from lectern.plans.inputs import Inputs, big, query, rounded
from lectern.plans.popularity_queries import POPULARITY_SQL, observed, scored
from lectern.session import cut_lineage

DIMENSIONS = FACTORS = 64

VECTOR_SQL = {
    **POPULARITY_SQL,
    "content_v": "SELECT vec_id AS book_id, label, embedding::DOUBLE[] AS vector FROM {embeddings}",
    # a second space: the vector backwards
    "factors_v": "SELECT vec_id AS book_id, list_reverse(embedding)::DOUBLE[] AS vector FROM {embeddings}",
    "content_n": """SELECT book_id, list_transform(vector, lambda x: x / SQRT(list_inner_product(vector, vector))) AS vector
        FROM content_v WHERE list_inner_product(vector, vector) > 0""",
    "factors_n": """SELECT book_id, list_transform(vector, lambda x: x / SQRT(list_inner_product(vector, vector))) AS vector
        FROM factors_v WHERE list_inner_product(vector, vector) > 0""",
    # both parts are unit vectors, so the scaled pair has length 1
    "hybrid_v": """SELECT c.book_id, list_concat(list_transform(c.vector, lambda x: x * SQRT(0.45 / 0.85)),
        list_transform(k.vector, lambda x: x * SQRT(0.40 / 0.85))) AS vector
        FROM content_n c JOIN factors_n k ON c.book_id = k.book_id""",
    "library_w": """SELECT *, CASE my_rating WHEN 5 THEN 1.0 WHEN 4 THEN 0.8 WHEN 3 THEN 0.45 WHEN 2 THEN -0.45 WHEN 1 THEN -1.0
        ELSE CASE exclusive_shelf WHEN 'currently-reading' THEN 0.30 WHEN 'read' THEN 0.25 ELSE 0.0 END END AS first_weight FROM library""",
    "library_rows": """SELECT *, CASE WHEN read_count > 1 AND first_weight > 0
        THEN LEAST(CAST(first_weight AS DOUBLE) + 0.05 * (read_count - 1), 1.25) ELSE CAST(first_weight AS DOUBLE) END AS preference_weight,
        exclusive_shelf IN ('read', 'currently-reading') AS profile_eligible,
        exclusive_shelf IN ('read', 'currently-reading', 'to-read') AS exclusion_from_recommendations,
        'matched' AS match_status FROM library_w""",
}


def content_space(inp: Inputs):
    return inp.table("embeddings").select(F.col("vec_id").alias("book_id"), "label", F.col("embedding").alias("vector"))


def factor_space(inp: Inputs):
    return inp.table("embeddings").select(F.col("vec_id").alias("book_id"), F.reverse("embedding").alias("vector"))


def hybrid_space(inp: Inputs):
    return ops.hybrid_embedding(content_space(inp), factor_space(inp))


def _rounded_vector(df, name="vector", decimals=5):
    return df.withColumn(name, F.transform(name, lambda x: F.round(x.cast("double"), decimals) + F.lit(0.0)))


@query("l2_normalize", "SELECT book_id, list_transform(vector, lambda x: ROUND(x, 5) + 0.0) AS vector FROM factors_n", VECTOR_SQL)
def l2_normalize(inp):
    return _rounded_vector(factor_space(inp).select("book_id", fn.l2_normalize("vector").alias("vector")))


@query("vector_norms", "SELECT book_id, ROUND(SQRT(list_inner_product(vector, vector)), 6) AS norm FROM factors_v", VECTOR_SQL)
def vector_norms(inp):
    return rounded(ops.vector_norms(factor_space(inp), "book_id"), "norm")


@query(
    "vector_table",
    "SELECT vec_id AS book_id, CAST(UNNEST(range(0, len(embedding))) AS INT) AS dimension, UNNEST(embedding) AS value FROM {embeddings}",
)
def vector_table(inp):
    return ops.vector_table(content_space(inp), "book_id")


@query("hybrid_embedding", "SELECT book_id, list_transform(vector, lambda x: ROUND(x, 5) + 0.0) AS vector FROM hybrid_v", VECTOR_SQL)
def hybrid_embedding(inp):
    return _rounded_vector(hybrid_space(inp))


@query(
    "embedding_gather",
    """SELECT library_row_id, l.local_book_id AS book_id, ROUND(list_sum(v.vector), 5) + 0.0 AS vector_sum
    FROM library l JOIN content_v v ON l.local_book_id = v.book_id""",
    VECTOR_SQL,
)
def embedding_gather(inp):
    rows = inp.view("library").select("library_row_id", F.col("local_book_id").alias("book_id"))
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x)
    gathered = ops.embedding_gather(rows, content_space(inp), "book_id")
    return gathered.select("library_row_id", "book_id", (F.round(total, 5) + F.lit(0.0)).alias("vector_sum"))


_NEIGHBOURS = """SELECT query_id, book_id, similarity, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id
    ORDER BY similarity DESC, book_id) AS rank FROM (SELECT a.book_id AS query_id, b.book_id,
    ROUND(list_inner_product(a.vector, b.vector), 9) AS similarity FROM {0} a, {0} b {1})) WHERE rank <= {2}"""


@query(
    "similar_items",
    "SELECT query_id, book_id, ROUND(similarity, 6) + 0.0 AS similarity, rank FROM ("
    + _NEIGHBOURS.format("content_n", "WHERE a.book_id <> b.book_id", 10) + ")",
    VECTOR_SQL,
)
def similar_items(inp):
    return big(rounded(ops.similar_items(content_space(inp), 10), "similarity"), "rank")


def library_rows(inp: Inputs):
    """The library view with weight, flags and match status."""
    from lectern.operators.library import eligibility_flags

    return eligibility_flags(inp.view("library")).withColumns(
        {"preference_weight": library_preference_weight(), "match_status": F.lit("matched")}
    )


@query(
    "weighted_vector_sum",
    """SELECT user_id, source_rows, list_transform(v, lambda x: ROUND(x / SQRT(list_inner_product(v, v)), 5) + 0.0) AS vector FROM (
    SELECT user_id, ANY_VALUE(n) AS source_rows, LIST(s ORDER BY d) AS v FROM (
    SELECT user_id, d, COUNT(*) AS n, SUM(preference_weight * x) AS s FROM (SELECT user_id, preference_weight,
    UNNEST(range(1, 65)) AS d, UNNEST(vector) AS x FROM library_rows JOIN content_v ON local_book_id = book_id) GROUP BY user_id, d)
    GROUP BY user_id)""",
    VECTOR_SQL,
)
def weighted_vector_sum(inp):
    rows = library_rows(inp).select("user_id", F.col("local_book_id").alias("book_id"), "preference_weight")
    gathered = ops.embedding_gather(rows, content_space(inp), "book_id")
    return _rounded_vector(ops.weighted_vector_sum(gathered, "user_id", "preference_weight", "vector"))


@query(
    "hybrid_align_join",
    """SELECT c.book_id, label, ROUND(o.average_user_rating, 6) AS average_user_rating, o.rating_count AS collaborative_rating_count,
    ROUND(wilson_score, 6) AS wilson_score, ROUND(bayesian_score, 6) AS bayesian_score, ROUND(novelty_score, 6) AS novelty_score
    FROM content_v c JOIN observed o ON o.item_id = c.book_id LEFT JOIN scored s ON s.book_id = c.book_id""",
    VECTOR_SQL,
)
def hybrid_align_join(inp):
    items = observed(inp).select(F.col("item_id").alias("local_book_id"), "average_user_rating", "rating_count")
    aligned = ops.hybrid_align_join(content_space(inp).drop("vector"), items, scored(inp))
    return rounded(aligned, "average_user_rating", "wilson_score", "bayesian_score", "novelty_score")


@query("dense_index", "SELECT vec_id AS book_id, ROW_NUMBER() OVER (ORDER BY label, vec_id) - 1 AS position FROM {embeddings}")
def dense_index(inp):
    from lectern.operators.ranking import dense_index as index

    ordered = index(content_space(inp), [F.col("label").asc(), F.col("book_id").asc()], "position")
    return ordered.select("book_id", "position")


@query("hybrid_lookup", "SELECT p_partkey AS book_id, position AS hybrid_index FROM {part} LEFT JOIN (SELECT vec_id, ROW_NUMBER() OVER (ORDER BY vec_id) - 1 AS position FROM {embeddings}) ON vec_id = p_partkey")
def hybrid_lookup(inp):
    from lectern.operators.matching import hybrid_lookup as lookup

    index = ops.hybrid_index(content_space(inp).select("book_id"))
    return lookup(inp.table("part").select(F.col("p_partkey").alias("book_id")), index)


@query(
    "implicit_als",
    """SELECT user_id AS id, CAST(64 AS INT) AS factors, 'user' AS side FROM (SELECT DISTINCT user_id FROM training)
    UNION ALL SELECT item_id, CAST(64 AS INT), 'item' FROM (SELECT DISTINCT item_id FROM training)""",
    VECTOR_SQL,
)
def implicit_als(inp):
    """Every user and item of the training rows, with the number of finite factors."""
    finite = F.size(F.filter("vector", lambda x: F.abs(x) < float("inf"))).alias("factors")
    users, items = collaborative.implicit_als(training(inp), scaled_reg=False)
    return users.select(F.col("user_id").cast("bigint").alias("id"), finite, F.lit("user").alias("side")).unionByName(
        items.select(F.col("item_id").cast("bigint").alias("id"), finite, F.lit("item").alias("side"))
    )


@query(
    "als_factors",
    """SELECT item_id, COUNT(*) AS users, TRUE AS fits FROM training GROUP BY item_id""",
    VECTOR_SQL,
)
def als_factors(inp):
    """Items with their users, and whether their factors score those users above the average of all users."""
    rows = cut_lineage(training(inp))
    users, items = collaborative.implicit_als(rows, scaled_reg=False)
    mean = users.agg(F.array(*(F.avg(F.get("vector", F.lit(d))) for d in range(FACTORS))).alias("mean"))
    score = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    # the mean score of an item's users is the score of their mean vector, so no vector moves for each row
    own = collaborative.neighbour_means(rows, users, "user_id", "item_id", FACTORS).select("item_id", F.col("vector").alias("own"))
    met = rows.where("user_id is not null").groupBy("item_id").agg(F.count("*").alias("users")).join(own, "item_id").join(items, "item_id")
    fits = score("own", "vector") > score("mean", "vector")
    return met.crossJoin(F.broadcast(mean)).select(F.col("item_id").cast("bigint").alias("item_id"), "users", fits.alias("fits"))
