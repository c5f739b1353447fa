"""Library rows, profiles, recommendations and explanations of many readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import scoring, text
from lectern.operators import explain as ex, library as lib, profile as prof, recommend as rec
from lectern.operators.similarity import knn_topk
from lectern.plans.inputs import Inputs, big, query, r6, rounded
from lectern.plans.popularity_queries import scored
from lectern.plans.vector_queries import (
    DIMENSIONS, FACTORS, VECTOR_SQL, content_space, factor_space, hybrid_space, library_rows,
)
from lectern.session import cut_lineage

REFERENCE_DATE, HALF_LIFE = "2024-02-01", 90.0
POOL, TOP, PER_AUTHOR = 200, 20, 3

_UNIT = "list_transform(v, lambda x: x / SQRT(list_inner_product(v, v)))"


def _space_sql(space: str, size: int) -> str:
    return f"""SELECT user_id, {_UNIT} AS vector FROM (SELECT user_id, LIST(s ORDER BY d) AS v FROM (
        SELECT user_id, d, SUM(effective_weight * x) / SUM(ABS(effective_weight)) AS s FROM (
        SELECT user_id, effective_weight, UNNEST(range(1, {size + 1})) AS d, UNNEST(vector) AS x
        FROM profile_r JOIN {space} ON local_book_id = book_id) GROUP BY user_id, d) GROUP BY user_id)
        WHERE list_inner_product(v, v) > 0"""


PERSONAL_SQL = {
    **VECTOR_SQL,
    "profile_r": f"""SELECT *, preference_weight AS base_weight, recency_multiplier * preference_weight AS effective_weight FROM (
        SELECT *, COALESCE(POW(0.5, GREATEST(DATE_DIFF('day', date_read, DATE '{REFERENCE_DATE}'), 0) / {HALF_LIFE}), 1.0) AS recency_multiplier
        FROM library_rows WHERE profile_eligible AND ABS(preference_weight) >= 0.05)
        WHERE ABS(recency_multiplier * preference_weight) >= 0.05""",
    "profile_content": _space_sql("content_v", DIMENSIONS),
    "profile_factors": _space_sql("factors_v", FACTORS),
    "profiles": """SELECT c.user_id, list_transform(list_concat(c.vector, k.vector), lambda x: x / SQRT(2.0)) AS vector
        FROM profile_content c JOIN profile_factors k ON c.user_id = k.user_id""",
    "nearest": f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY hybrid_similarity DESC, book_id) AS place
        FROM (SELECT p.user_id, h.book_id, ROUND(list_inner_product(p.vector, h.vector), 9) AS hybrid_similarity
        FROM profiles p, hybrid_v h)) WHERE place <= {POOL}""",
    "shelf_catalog": "SELECT * FROM shelf_books",
    "excluded": "SELECT DISTINCT l.user_id, l.local_book_id, b.work_id FROM library_rows l LEFT JOIN shelf_books b ON b.book_id = l.local_book_id WHERE exclusion_from_recommendations",
    "candidates": """SELECT n.user_id, n.book_id, n.hybrid_similarity, s.work_id, s.title, s.primary_author, s.primary_genre,
        s.language_code, s.ratings_count, s.average_rating FROM nearest n LEFT JOIN shelf_catalog s ON s.book_id = n.book_id""",
    "unknown": """SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM excluded e WHERE e.user_id = c.user_id AND e.local_book_id = c.book_id)
        AND NOT EXISTS (SELECT 1 FROM excluded e WHERE e.user_id = c.user_id AND e.work_id = c.work_id)""",
    "scaled": """SELECT *, CASE WHEN MAX(hybrid_similarity) OVER w > MIN(hybrid_similarity) OVER w
          THEN (hybrid_similarity - MIN(hybrid_similarity) OVER w) / (MAX(hybrid_similarity) OVER w - MIN(hybrid_similarity) OVER w) ELSE 0.0 END AS similarity_component,
        CASE WHEN MAX(pop) OVER w > MIN(pop) OVER w THEN (pop - MIN(pop) OVER w) / (MAX(pop) OVER w - MIN(pop) OVER w) ELSE 0.0 END AS popularity_component,
        CASE WHEN MAX(average_rating) OVER w > MIN(average_rating) OVER w
          THEN (average_rating - MIN(average_rating) OVER w) / (MAX(average_rating) OVER w - MIN(average_rating) OVER w) ELSE 0.0 END AS quality_component
        FROM (SELECT *, LN(1 + COALESCE(ratings_count, 0)) AS pop FROM unknown) WINDOW w AS (PARTITION BY user_id)""",
    "reranked": """SELECT *, 1 - popularity_component AS novelty_component,
        ROUND(0.85 * similarity_component + 0.10 * popularity_component + 0.05 * quality_component, 9) AS recommendation_score FROM scaled""",
    "capped": f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, LOWER(TRIM(COALESCE(NULLIF(primary_author, ''), 'Unknown')))
        ORDER BY recommendation_score DESC NULLS LAST, hybrid_similarity DESC, book_id) AS author_place FROM reranked)
        WHERE author_place <= {PER_AUTHOR}""",
    "ranked": f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
        ORDER BY recommendation_score DESC NULLS LAST, hybrid_similarity DESC, book_id) AS rank FROM capped) WHERE rank <= {TOP}""",
    # the pool of the recommendations: the nearest of those that the user does not know
    "open_pool": f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY hybrid_similarity DESC, book_id) AS place
        FROM (SELECT p.user_id, h.book_id, ROUND(list_inner_product(p.vector, h.vector), 9) AS hybrid_similarity, s.work_id, s.title,
        s.primary_author, s.primary_genre, s.language_code, s.ratings_count, s.average_rating
        FROM profiles p CROSS JOIN hybrid_v h LEFT JOIN shelf_catalog s ON s.book_id = h.book_id) c
        WHERE NOT EXISTS (SELECT 1 FROM excluded e WHERE e.user_id = c.user_id AND e.local_book_id = c.book_id)
        AND NOT EXISTS (SELECT 1 FROM excluded e WHERE e.user_id = c.user_id AND e.work_id = c.work_id)) WHERE place <= {POOL}""",
    "open_scaled": """SELECT *, CASE WHEN MAX(hybrid_similarity) OVER w > MIN(hybrid_similarity) OVER w
          THEN (hybrid_similarity - MIN(hybrid_similarity) OVER w) / (MAX(hybrid_similarity) OVER w - MIN(hybrid_similarity) OVER w) ELSE 0.0 END AS similarity_component,
        CASE WHEN MAX(pop) OVER w > MIN(pop) OVER w THEN (pop - MIN(pop) OVER w) / (MAX(pop) OVER w - MIN(pop) OVER w) ELSE 0.0 END AS popularity_component,
        CASE WHEN MAX(average_rating) OVER w > MIN(average_rating) OVER w
          THEN (average_rating - MIN(average_rating) OVER w) / (MAX(average_rating) OVER w - MIN(average_rating) OVER w) ELSE 0.0 END AS quality_component
        FROM (SELECT *, LN(1 + COALESCE(ratings_count, 0)) AS pop FROM open_pool) WINDOW w AS (PARTITION BY user_id)""",
    "open_reranked": """SELECT *, 1 - popularity_component AS novelty_component,
        ROUND(0.85 * similarity_component + 0.10 * popularity_component + 0.05 * quality_component, 9) AS recommendation_score FROM open_scaled""",
    "open_capped": f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, LOWER(TRIM(COALESCE(NULLIF(primary_author, ''), 'Unknown')))
        ORDER BY recommendation_score DESC NULLS LAST, hybrid_similarity DESC, book_id) AS author_place FROM open_reranked)
        WHERE author_place <= {PER_AUTHOR}""",
    "recommended": f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
        ORDER BY recommendation_score DESC NULLS LAST, hybrid_similarity DESC, book_id) AS rank FROM open_capped) WHERE rank <= {TOP}""",
    "pool_rows": """SELECT r.*, b.title AS matched_title, b.primary_author AS matched_author, b.primary_genre AS matched_primary_genre,
        effective_weight AS explanation_weight FROM profile_r r JOIN shelf_books b ON b.book_id = r.local_book_id WHERE effective_weight >= 0.2""",
    "pairs": """SELECT p.*, r.rank, r.book_id, r.primary_genre AS rec_genre, r.primary_author AS rec_author,
        list_inner_product(a.vector, b.vector) AS content_similarity FROM recommended r
        JOIN pool_rows p ON p.user_id = r.user_id JOIN content_n a ON a.book_id = r.book_id JOIN content_n b ON b.book_id = p.local_book_id""",
    "evidence": """SELECT *, content_similarity * SQRT(explanation_weight) + CASE WHEN shared_genre THEN 0.10 ELSE 0 END
        + CASE WHEN shared_author THEN 0.10 ELSE 0 END AS evidence_score FROM (SELECT *,
        LOWER(TRIM(rec_genre)) = LOWER(TRIM(matched_primary_genre)) AS shared_genre,
        LOWER(TRIM(rec_author)) = LOWER(TRIM(matched_author)) AS shared_author FROM pairs WHERE content_similarity >= 0.05)""",
}


def profile(inp: Inputs):
    return prof.profile_rows(library_rows(inp), REFERENCE_DATE, HALF_LIFE)


def profiles(inp: Inputs):
    return cut_lineage(prof.user_profile(profile(inp), content_space(inp), factor_space(inp)))


def exclusions(inp: Inputs):
    works = inp.view("shelf_books").select(F.col("book_id").alias("local_book_id"), "work_id")
    known = library_rows(inp).where(F.col("exclusion_from_recommendations"))
    # read twice: by book and by work
    return cut_lineage(known.join(works, "local_book_id", "left").select("user_id", "local_book_id", "work_id").distinct())


def recommended(inp: Inputs):
    return rec.recommend(
        profiles(inp), hybrid_space(inp), inp.view("shelf_books"), exclusions(inp), POOL, TOP, max_per_author=PER_AUTHOR
    )


def candidates(inp: Inputs):
    near = knn_topk(profiles(inp), hybrid_space(inp), POOL).drop("rank").withColumnRenamed("similarity", "hybrid_similarity")
    return rec.candidate_join(near, inp.view("shelf_books"))


def reranked(inp: Inputs):
    return rec.rerank_minmax(rec.exclusion_anti_join(candidates(inp), exclusions(inp)))


def pool(inp: Inputs):
    books = inp.view("shelf_books").select(
        F.col("book_id").alias("local_book_id"), F.col("title").alias("matched_title"),
        F.col("primary_author").alias("matched_author"), F.col("primary_genre").alias("matched_primary_genre"),
    )
    return ex.evidence_pool(profile(inp).join(books, "local_book_id"))


def evidence(inp: Inputs):
    return ex.evidence_candidates(recommended(inp), pool(inp), content_space(inp))


@query("library_preference_weight", "SELECT library_row_id, my_rating, exclusive_shelf, read_count, ROUND(preference_weight, 6) AS preference_weight FROM library_rows", PERSONAL_SQL)
def library_preference_weight(inp):
    return rounded(
        library_rows(inp).select("library_row_id", "my_rating", "exclusive_shelf", "read_count", "preference_weight"),
        "preference_weight",
    )


@query("eligibility_flags", "SELECT library_row_id, profile_eligible, exclusion_from_recommendations FROM library_rows", PERSONAL_SQL)
def eligibility_flags(inp):
    return library_rows(inp).select("library_row_id", "profile_eligible", "exclusion_from_recommendations")


@query(
    "shelf_filter",
    """SELECT library_row_id, exclusive_shelf, bookshelves FROM (SELECT *, CASE library_row_id % 4 WHEN 0 THEN 'own, To Sell' WHEN 1
    THEN 'own' WHEN 2 THEN '' ELSE 'to sell,gift' END AS bookshelves FROM library)
    WHERE exclusive_shelf IN ('read', 'currently-reading', 'to-read') AND NOT regexp_matches(LOWER(bookshelves), '(^|,) *to sell *(,|$)') AND LENGTH(input_title) > 0""",
)
def shelf_filter(inp):
    n = F.col("library_row_id") % 4
    shelves = F.when(n == 0, "own, To Sell").when(n == 1, "own").when(n == 2, "").otherwise("to sell,gift")
    rows = inp.view("library").withColumn("bookshelves", shelves).withColumnRenamed("input_title", "title")
    return lib.shelf_filter(rows, exclude=["to sell"]).select("library_row_id", "exclusive_shelf", "bookshelves")


@query(
    "lenient_date",
    """SELECT event_id, CASE WHEN event_id % 6 < 5 THEN CAST(ts AS DATE) END AS date_read FROM {events}""",
)
def lenient_date(inp):
    n, shown = F.col("event_id") % 6, None
    for i, pattern in enumerate(("yyyy/MM/dd", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm'Z'", "M/d/yyyy")):
        shown = (F if shown is None else shown).when(n == i, F.date_format("ts", pattern))
    shown = shown.otherwise("someday")
    return inp.table("events").select("event_id", text.lenient_date(shown).alias("date_read"))


@query(
    "recency_decay",
    f"""SELECT library_row_id, ROUND(POW(0.5, GREATEST(DATE_DIFF('day', date_read, DATE '{REFERENCE_DATE}'), 0) / {HALF_LIFE}), 6)
    AS recency_multiplier FROM library""",
)
def recency_decay(inp):
    decay = scoring.recency_decay("date_read", REFERENCE_DATE, HALF_LIFE)
    return inp.view("library").select("library_row_id", r6(decay).alias("recency_multiplier"))


@query(
    "profile_rows",
    """SELECT library_row_id, user_id, local_book_id, ROUND(base_weight, 6) AS base_weight, ROUND(recency_multiplier, 6) AS recency_multiplier,
    ROUND(effective_weight, 6) AS effective_weight FROM profile_r""",
    PERSONAL_SQL,
)
def profile_rows(inp):
    rows = profile(inp).select(
        "library_row_id", "user_id", "local_book_id", "base_weight", "recency_multiplier", "effective_weight"
    )
    return rounded(rows, "base_weight", "recency_multiplier", "effective_weight")


@query(
    "profile_catalog_join",
    """SELECT library_row_id, primary_author, primary_genre FROM profile_r LEFT JOIN shelf_books ON book_id = local_book_id""",
    PERSONAL_SQL,
)
def profile_catalog_join(inp):
    joined = prof.profile_catalog_join(profile(inp), inp.view("shelf_books"))
    return joined.select("library_row_id", "primary_author", "primary_genre")


def _favorite_sql(column: str, top: int) -> str:
    return f"""SELECT user_id, {column}, ROUND(w, 6) AS weighted_preference, books, rank FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY user_id ORDER BY ROUND(w, 9) DESC, books DESC, {column}) AS rank FROM (
        SELECT user_id, {column}, SUM(effective_weight) AS w, COUNT(DISTINCT local_book_id) AS books
        FROM profile_r JOIN shelf_books ON book_id = local_book_id WHERE effective_weight > 0 AND {column} IS NOT NULL
        GROUP BY user_id, {column})) WHERE rank <= {top}"""


@query("favorite_authors", _favorite_sql("primary_author", 30), PERSONAL_SQL)
def favorite_authors(inp):
    return big(rounded(prof.favorite_authors(profile(inp), inp.view("shelf_books")), "weighted_preference"), "rank")


@query("favorite_genres", _favorite_sql("primary_genre", 3), PERSONAL_SQL)
def favorite_genres(inp):
    return big(rounded(prof.favorite_genres(profile(inp), inp.view("shelf_books"), 3), "weighted_preference"), "rank")


@query(
    "profile_sources",
    """SELECT user_id, library_row_id, local_book_id, 'content' AS space, ROUND(base_weight, 6) AS base_weight,
    ROUND(recency_multiplier, 6) AS recency_multiplier, ROUND(effective_weight, 6) AS effective_weight
    FROM profile_r WHERE local_book_id IN (SELECT book_id FROM content_v)""",
    PERSONAL_SQL,
)
def profile_sources(inp):
    return rounded(
        prof.profile_sources(profile(inp), content_space(inp), "content"), "base_weight", "recency_multiplier", "effective_weight"
    )


@query("user_profile", "SELECT user_id, list_transform(vector, lambda x: ROUND(x, 5) + 0.0) AS vector FROM profiles", PERSONAL_SQL)
def user_profile(inp):
    vector = F.transform("vector", lambda x: F.round(x, 5) + F.lit(0.0))
    return profiles(inp).select("user_id", vector.alias("vector"))


@query(
    "profile_statistics",
    """SELECT user_id, COUNT(*) AS profile_rows_used, COUNT(*) FILTER (effective_weight > 0) AS positive_rows,
    COUNT(*) FILTER (effective_weight < 0) AS negative_rows, ROUND(AVG(effective_weight), 6) + 0.0 AS mean_effective_weight,
    ROUND(SUM(ABS(effective_weight)), 6) AS absolute_weight_sum FROM profile_r GROUP BY user_id""",
    PERSONAL_SQL,
)
def profile_statistics(inp):
    return rounded(prof.profile_statistics(profile(inp)), "mean_effective_weight", "absolute_weight_sum")


@query(
    "distribution_counts",
    """SELECT 'exclusive_shelf' AS column, exclusive_shelf AS value, COUNT(*) AS rows FROM library GROUP BY exclusive_shelf
    UNION ALL SELECT 'my_rating', CAST(my_rating AS VARCHAR), COUNT(*) FROM library GROUP BY my_rating""",
)
def distribution_counts(inp):
    return lib.distribution_counts(inp.view("library"), ["exclusive_shelf", "my_rating"])


@query(
    "split_by_status",
    """SELECT 'matched' AS split, COUNT(*) AS rows FROM library_rows WHERE library_row_id % 4 > 1
    UNION ALL SELECT 'cold_start', COUNT(*) FROM library_rows WHERE library_row_id % 4 = 0
    UNION ALL SELECT 'unmatched', COUNT(*) FROM library_rows WHERE library_row_id % 4 = 1
    UNION ALL SELECT 'profile_books', COUNT(*) FROM library_rows WHERE profile_eligible AND preference_weight <> 0
    UNION ALL SELECT 'exclusion_books', COUNT(*) FROM library_rows WHERE exclusion_from_recommendations""",
    PERSONAL_SQL,
)
def split_by_status(inp):
    n = F.col("library_row_id") % 4
    status = F.when(n == 0, "cold_start").when(n == 1, "unmatched").otherwise("matched")
    parts = [
        df.agg(F.count("*").alias("rows")).withColumn("split", F.lit(name))
        for name, df in lib.split_by_status(library_rows(inp).withColumn("match_status", status)).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "knn_topk",
    "SELECT user_id, book_id, ROUND(hybrid_similarity, 6) + 0.0 AS similarity, place AS rank FROM nearest",
    PERSONAL_SQL,
)
def knn_topk_query(inp):
    return big(rounded(knn_topk(profiles(inp), hybrid_space(inp), POOL), "similarity"), "rank")


@query(
    "candidate_join",
    "SELECT user_id, book_id, ROUND(hybrid_similarity, 6) + 0.0 AS hybrid_similarity, title, primary_author, ratings_count FROM candidates",
    PERSONAL_SQL,
)
def candidate_join(inp):
    shown = candidates(inp).select("user_id", "book_id", "hybrid_similarity", "title", "primary_author", "ratings_count")
    return rounded(shown, "hybrid_similarity")


@query("id_semi_filter", "SELECT book_id, title FROM shelf_books WHERE book_id IN (SELECT book_id FROM nearest)", PERSONAL_SQL)
def id_semi_filter(inp):
    near = knn_topk(profiles(inp), hybrid_space(inp), POOL)
    return rec.id_semi_filter(inp.view("shelf_books"), near, "book_id").select("book_id", "title")


@query("exclusion_anti_join", "SELECT user_id, book_id, work_id FROM unknown", PERSONAL_SQL)
def exclusion_anti_join(inp):
    return rec.exclusion_anti_join(candidates(inp), exclusions(inp)).select("user_id", "book_id", "work_id")


@query(
    "candidate_filters",
    """SELECT user_id, book_id FROM candidates WHERE COALESCE(ratings_count, 0) >= 10 AND LOWER(language_code) = 'en-us'
    AND LOWER(primary_genre) LIKE '%econ%' AND LOWER(COALESCE(primary_author, '')) NOT LIKE '%#1%'""",
    PERSONAL_SQL,
)
def candidate_filters(inp):
    kept = rec.candidate_filters(candidates(inp), 10, "EN-us", "Econ", ["#1"])
    return kept.select("user_id", "book_id")


@query(
    "rerank_minmax",
    """SELECT user_id, book_id, ROUND(similarity_component, 6) AS similarity_component, ROUND(popularity_component, 6) AS popularity_component,
    ROUND(quality_component, 6) AS quality_component, ROUND(novelty_component, 6) AS novelty_component,
    ROUND(recommendation_score, 6) AS recommendation_score FROM reranked""",
    PERSONAL_SQL,
)
def rerank_minmax(inp):
    parts = ("similarity_component", "popularity_component", "quality_component", "novelty_component", "recommendation_score")
    return rounded(reranked(inp).select("user_id", "book_id", *parts), *parts)


@query(
    "minmax_scale",
    """SELECT l_orderkey, l_linenumber, CASE WHEN MAX(l_quantity) OVER w > MIN(l_quantity) OVER w
    THEN ROUND((l_quantity - MIN(l_quantity) OVER w) / (MAX(l_quantity) OVER w - MIN(l_quantity) OVER w), 6) ELSE 0.0 END AS scaled
    FROM {lineitem} WINDOW w AS (PARTITION BY l_orderkey)""",
)
def minmax_scale(inp):
    scaled = scoring.minmax_scale("l_quantity", ["l_orderkey"])
    return inp.table("lineitem").select("l_orderkey", "l_linenumber", r6(scaled).alias("scaled"))


@query("log_popularity", "SELECT book_id, ROUND(LN(1 + COALESCE(ratings_count, 0)), 6) AS popularity FROM books")
def log_popularity(inp):
    return inp.view("books").select("book_id", r6(scoring.log_popularity()).alias("popularity"))


@query("quality_source", "SELECT book_id, ROUND(average_rating, 6) AS quality FROM shelf_books")
def quality_source(inp):
    books = inp.view("shelf_books")
    return books.select("book_id", r6(rec.quality_source(books.columns)).alias("quality"))


_HYBRID_PARTS = """0.40 * hybrid_similarity + 0.30 * similarity_component + 0.15 * COALESCE(quality_component, 0)
    + 0.10 * popularity_component + 0.05 * novelty_component"""


@query("hybrid_score", f"SELECT user_id, book_id, ROUND({_HYBRID_PARTS}, 6) + 0.0 AS hybrid_score FROM reranked", PERSONAL_SQL)
def hybrid_score(inp):
    parts = {
        "collaborative": "hybrid_similarity", "content": "similarity_component",
        "rating_quality": F.coalesce("quality_component", F.lit(0.0)), "preference_match": "popularity_component",
        "novelty": "novelty_component",
    }
    return reranked(inp).select("user_id", "book_id", r6(scoring.hybrid_score(parts)).alias("hybrid_score"))


@query(
    "percentile_rerank",
    """SELECT user_id, c.book_id, ROUND(0.85 * hybrid_similarity + 0.10 * p.popularity + 0.05 * p.novelty, 6) + 0.0 AS final_score
    FROM candidates c JOIN (SELECT book_id, CUME_DIST() OVER (ORDER BY wilson_score NULLS FIRST) AS popularity,
    CUME_DIST() OVER (ORDER BY novelty_score NULLS FIRST) AS novelty FROM scored) p ON p.book_id = c.book_id""",
    PERSONAL_SQL,
)
def percentile_rerank(inp):
    from lectern.operators.popularity import percentiles

    shares = percentiles(scored(inp), {"wilson_score": "popularity", "novelty_score": "novelty"})
    joined = candidates(inp).select("user_id", "book_id", "hybrid_similarity").join(
        shares.select("book_id", "popularity", "novelty"), "book_id"
    )
    score = scoring.percentile_rerank("hybrid_similarity", "popularity", "novelty")
    return joined.select("user_id", "book_id", r6(score).alias("final_score"))


@query("author_cap", "SELECT user_id, book_id, primary_author FROM capped", PERSONAL_SQL)
def author_cap(inp):
    return rec.author_cap(reranked(inp), max_per_author=PER_AUTHOR).select("user_id", "book_id", "primary_author")


@query("output_rank", "SELECT user_id, book_id, rank FROM ranked", PERSONAL_SQL)
def output_rank(inp):
    ranked = rec.output_rank(rec.author_cap(reranked(inp), max_per_author=PER_AUTHOR), top=TOP)
    return big(ranked.select("user_id", "book_id", "rank"), "rank")


_REASON = """concat_ws('; ', 'hybrid similarity ' || format('{:.3f}', hybrid_similarity),
    CASE WHEN TRIM(primary_genre) <> '' THEN 'genre: ' || primary_genre END, 'rating ' || format('{:.2f}', average_rating))"""


@query("recommendation_reason", f"SELECT user_id, rank, {_REASON} AS recommendation_reason FROM recommended", PERSONAL_SQL)
def recommendation_reason(inp):
    return big(recommended(inp).select("user_id", "rank", "recommendation_reason"), "rank")


@query(
    "recommend",
    """SELECT user_id, rank, book_id, work_id, title, primary_author, primary_genre, ROUND(hybrid_similarity, 6) + 0.0 AS hybrid_similarity,
    ROUND(recommendation_score, 6) AS recommendation_score FROM recommended""",
    PERSONAL_SQL,
)
def recommend(inp):
    shown = recommended(inp).select(
        "user_id", "rank", "book_id", "work_id", "title", "primary_author", "primary_genre", "hybrid_similarity",
        "recommendation_score",
    )
    return big(rounded(shown, "hybrid_similarity", "recommendation_score"), "rank")


@query("evidence_pool", "SELECT user_id, library_row_id, ROUND(explanation_weight, 6) AS explanation_weight FROM pool_rows", PERSONAL_SQL)
def evidence_pool(inp):
    return rounded(pool(inp).select("user_id", "library_row_id", "explanation_weight"), "explanation_weight")


@query(
    "evidence_cross_join",
    "SELECT user_id, rank, library_row_id, ROUND(content_similarity, 6) + 0.0 AS content_similarity FROM pairs",
    PERSONAL_SQL,
)
def evidence_cross_join(inp):
    pairs = ex.evidence_cross_join(recommended(inp), pool(inp), content_space(inp))
    return big(rounded(pairs.select("user_id", "rank", "library_row_id", "content_similarity"), "content_similarity"), "rank")


@query(
    "evidence_candidates",
    """SELECT user_id, rank, library_row_id, shared_genre, shared_author, ROUND(ROUND(evidence_score, 9), 6) AS evidence_score FROM evidence""",
    PERSONAL_SQL,
)
def evidence_candidates(inp):
    shown = evidence(inp).select("user_id", "rank", "library_row_id", "shared_genre", "shared_author", "evidence_score")
    return big(rounded(shown, "evidence_score"), "rank")


# the greedy choice as a recursion: a step for each place of each recommendation, with all picks of the user so far
_CHOSEN = f"""SELECT * FROM (WITH RECURSIVE offered AS (SELECT *, ROUND(evidence_score, 9) AS score, LOWER(TRIM(COALESCE(NULLIF(matched_author, ''), input_author, ''))) AS author_key,
    LOWER(TRIM(COALESCE(NULLIF(input_author, ''), NULLIF(matched_author, ''), 'Unknown author'))) AS cited_key FROM evidence WHERE rank <= {TOP}),
    greedy AS (SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS step, CAST([] AS STRUCT("rank" BIGINT, place BIGINT, row_id BIGINT, author VARCHAR, uses BIGINT)[]) AS picks FROM offered
    UNION ALL SELECT user_id, step + 1, CASE WHEN row_id IS NULL THEN picks ELSE list_append(picks,
        {{'rank': step // 3 + 1, 'place': step % 3 + 1, 'row_id': row_id, 'author': cited_key, 'uses': used + 1}}) END
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ROUND(score + CASE WHEN fresh THEN 0.05 ELSE 0 END - 0.02 * used, 9) DESC NULLS LAST,
        score DESC, explanation_weight DESC, row_id) AS place FROM (
        SELECT g.user_id, g.step, g.picks, o.library_row_id AS row_id, o.cited_key, o.score, o.explanation_weight,
            len(list_filter(g.picks, lambda p: p.row_id = o.library_row_id)) AS used,
            o.author_key <> '' AND len(list_filter(g.picks, lambda p: p.rank = g.step // 3 + 1 AND p.author = o.author_key)) = 0 AS fresh
        FROM greedy g LEFT JOIN offered o ON o.user_id = g.user_id AND o.rank = g.step // 3 + 1
            AND len(list_filter(g.picks, lambda p: p.row_id = o.library_row_id)) < 5
            AND len(list_filter(g.picks, lambda p: p.rank = g.step // 3 + 1 AND p.row_id = o.library_row_id)) = 0
        WHERE g.step < {3 * TOP})) WHERE place = 1)
    SELECT o.user_id, CAST(o.rank AS BIGINT) AS rank, p.place AS evidence_rank, o.library_row_id, COALESCE(NULLIF(input_title, ''), matched_title) AS title,
        COALESCE(NULLIF(input_author, ''), matched_author) AS author, CAST(my_rating AS DOUBLE) AS rating, ROUND(explanation_weight, 6) + 0.0 AS weight,
        ROUND(content_similarity, 6) + 0.0 AS content_similarity, ROUND(score, 6) + 0.0 AS evidence_score, shared_genre, shared_author, p.uses AS global_usage_count
    FROM (SELECT user_id AS chooser, UNNEST(picks) AS p FROM greedy WHERE step = {3 * TOP}) JOIN offered o
    ON o.user_id = chooser AND o.rank = p.rank AND o.library_row_id = p.row_id)"""


@query("evidence_select", _CHOSEN, PERSONAL_SQL)
def evidence_select(inp):
    picks = ex.evidence_select(evidence(inp), max_recommendations=TOP)
    return big(rounded(picks, "weight", "content_similarity", "evidence_score"), "rank", "evidence_rank", "global_usage_count")


def with_evidence(inp: Inputs):
    """The recommendations with the books that the greedy selection cites."""
    recs = cut_lineage(recommended(inp))
    picks = ex.evidence_select(
        ex.evidence_candidates(recs, pool(inp), content_space(inp)), max_recommendations=TOP
    )
    return ex.evidence_summary(recs, picks)


@query("evidence_summary")
def evidence_summary(inp):
    return with_evidence(inp).select("user_id", "rank", "evidence_books", "evidence_book_count", "strongest_evidence_similarity")


@query("explain")
def explain(inp):
    told = ex.explain(recommended(inp), pool(inp), content_space(inp), top=TOP, model_details=True)
    return told.select("user_id", "rank", "book_id", "short_explanation", "explanation", "evidence_books")


# the long text is checked with the single best evidence book, which SQL can rank
_BEST = """SELECT r.*, e.input_title, e.input_author, e.content_similarity, e.shared_genre, e.shared_author FROM recommended r
    LEFT JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, rank
    ORDER BY ROUND(evidence_score, 9) DESC, explanation_weight DESC, library_row_id) AS place FROM evidence) WHERE place = 1) e
    ON e.user_id = r.user_id AND e.rank = r.rank"""
TEXT_SQL = {**PERSONAL_SQL, "cited": _BEST}


def with_best_evidence(inp: Inputs):
    recs = cut_lineage(recommended(inp))
    best = ex.best_evidence(ex.evidence_candidates(recs, pool(inp), content_space(inp)))
    return ex.evidence_summary(recs, best)


@query(
    "shared_value",
    """SELECT library_row_id, LOWER(TRIM(input_author)) = LOWER(TRIM(primary_author)) AND TRIM(input_author) <> '' AS shared_author
    FROM library JOIN shelf_books ON book_id = local_book_id""",
)
def shared_value(inp):
    joined = inp.view("library").join(inp.view("shelf_books"), F.col("local_book_id") == F.col("book_id"))
    return joined.select("library_row_id", text.shared_value("input_author", "primary_author").alias("shared_author"))


@query("normalized_key", "SELECT DISTINCT LOWER(TRIM(COALESCE(p_brand, ''))) AS key, LOWER(TRIM(COALESCE(p_name, ''))) AS title FROM {part}")
def normalized_key(inp):
    return inp.table("part").select(
        text.normalized_key("p_brand").alias("key"), text.normalized_key("p_name").alias("title")
    ).distinct()


@query(
    "json_encode",
    """SELECT l_orderkey, '[' || STRING_AGG('{"line":' || l_linenumber || ',"flag":"' || l_returnflag || '"}', ',' ORDER BY l_linenumber, l_returnflag) || ']' AS lines
    FROM {lineitem} GROUP BY l_orderkey""",
)
def json_encode(inp):
    line = F.struct(F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("flag"))
    orders = inp.table("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    return orders.select("l_orderkey", text.json_encode("lines").alias("lines"))


@query(
    "short_explanation",
    f"""SELECT r.user_id, r.rank, CASE WHEN cited_books IS NOT NULL THEN 'Related to ' || cited_books || ' (content similarities: ' || similarities || ')'
    ELSE 'Strong hybrid match in ' || primary_genre END AS short_explanation FROM recommended r LEFT JOIN (
    SELECT c.user_id, c.rank, string_agg(TRIM(c.title) || ' by ' || TRIM(c.author), ' and ' ORDER BY c.evidence_rank) AS cited_books,
    string_agg(format('{{:.2f}}', e.content_similarity), ', ' ORDER BY c.evidence_rank) AS similarities FROM ({_CHOSEN}) c JOIN evidence e
    ON e.user_id = c.user_id AND e.rank = c.rank AND e.library_row_id = c.library_row_id WHERE c.evidence_rank <= 2
    GROUP BY c.user_id, c.rank) b ON b.user_id = r.user_id AND b.rank = r.rank""",
    PERSONAL_SQL,
)
def short_explanation(inp):
    return big(with_evidence(inp).select("user_id", "rank", ex.short_explanation().alias("short_explanation")), "rank")


EXPLAINED = """SELECT user_id, rank, UPPER(t[1]) || t[2:] || '.' AS explanation FROM (SELECT user_id, rank, concat_ws('; ',
    'It is close in content to books you liked, especially ' || input_title || ' by ' || input_author,
    CASE WHEN shared_genre THEN 'it reinforces your apparent interest in ' || primary_genre
         ELSE 'it fits the ' || primary_genre || ' part of your reading profile' END,
    CASE WHEN shared_author THEN 'you have already shown interest in ' || primary_author END,
    CASE WHEN average_rating >= 4 THEN 'it also has a strong reader rating of ' || format('{:.2f}', average_rating)
         WHEN ratings_count >= 10000 THEN 'it has substantial reader support' END,
    'model evidence: hybrid similarity ' || format('{:.3f}', hybrid_similarity) || ', final score ' || format('{:.3f}', recommendation_score)) AS t FROM cited)"""


@query("explanation_text", EXPLAINED, TEXT_SQL)
def explanation_text(inp):
    summary = with_best_evidence(inp)
    return big(summary.select("user_id", "rank", ex.explanation_text(summary.columns, True).alias("explanation")), "rank")
