"""Candidates, filters, rerank, author cap and the recommendation pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions.scoring import (
    RERANK_WEIGHTS, log_popularity, minmax_scale, percentile_rerank, shares,
)
from lectern.operators.ranking import top_k
from lectern.operators.similarity import knn_topk
from lectern.operators.svd import SvdModel, svd_project
from lectern.operators.content import TfidfModel, tfidf_transform
from lectern.session import cut_lineage

QUALITY_COLUMNS = ("bayesian_rating", "wilson_lower_bound", "average_rating")


def id_semi_filter(table: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose id occurs among the candidates."""
    return table.join(ids.select(on), on, "left_semi")


def candidate_join(candidates: DataFrame, catalog: DataFrame, on: str = "book_id") -> DataFrame:
    return candidates.join(catalog, on, "left")


def exclusion_anti_join(candidates: DataFrame, exclusions: DataFrame, by: str = "user_id", by_work: bool = True) -> DataFrame:
    """Without the user's known books and, ``by_work``, other editions of them."""
    works = by_work and "work_id" in candidates.columns
    ids = {"book_id": "local_book_id", "work_id": "work_id"} if works else {"book_id": "local_book_id"}
    kinds = {f.name: f.dataType for f in candidates.schema}
    known = exclusions.where(F.col(by).isNotNull()).select(
        F.col(by).try_cast(kinds[by]).alias(by), *(F.col(c).try_cast(kinds[k]).alias(k) for k, c in ids.items()), F.lit(True).alias("_known"))
    # both sides meet by user: what follows is per user too, and the rows move once instead of once for each kind of id
    met = candidates.withColumn("_known", F.lit(False)).unionByName(known, allowMissingColumns=True).repartition(by)
    seen = {f"_seen_{c}": F.col(c).isNotNull() & F.max("_known").over(Window.partitionBy(by, c)) for c in ids}
    return met.withColumns(seen).where(~F.col("_known")).where(~F.greatest(*seen, F.lit(False))).select(*candidates.columns)


def candidate_filters(
    candidates: DataFrame,
    minimum_ratings: int = 0,
    language: str | None = None,
    genre: str | None = None,
    exclude_authors: Sequence[str] = (),
) -> DataFrame:
    """Optional count, language (exact), genre and author (substring) filters."""
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    if minimum_ratings > 0:
        candidates = candidates.where(F.coalesce("ratings_count", F.lit(0)) >= minimum_ratings)
    if language:
        candidates = candidates.where(low("language_code") == language.lower())
    if genre:
        candidates = candidates.where(F.contains(low("primary_genre"), F.lit(genre.lower())))
    for author in exclude_authors:
        candidates = candidates.where(~F.contains(low("primary_author"), F.lit(author.lower())))
    return candidates


def excluded_counts(
    vectors: DataFrame, catalog: DataFrame, exclusions: DataFrame, by: str = "user_id", by_work: bool = True
) -> DataFrame:
    """(user, _excluded): how many of the vectors' books the exclusions take from each user."""
    books = vectors.select("book_id")
    gone = exclusions.select(by, F.col("local_book_id").alias("book_id")).join(books, "book_id", "left_semi").select(by, "book_id")
    if by_work and "work_id" in catalog.columns:
        editions = books.join(catalog.select("book_id", "work_id"), "book_id").where(F.col("work_id").isNotNull())
        others = exclusions.where(F.col("work_id").isNotNull()).select(by, "work_id").distinct().join(editions, "work_id")
        gone = gone.unionByName(others.select(by, "book_id"))
    return gone.distinct().groupBy(by).agg(F.count("*").alias("_excluded"))


def quality_source(columns: Sequence[str]) -> str | None:
    """The first quality column the candidates have."""
    return next((c for c in QUALITY_COLUMNS if c in columns), None)


def rerank_order() -> list[Column]:
    return [
        F.col("recommendation_score").desc_nulls_last(),
        F.col("hybrid_similarity").desc_nulls_last(),
        F.col("book_id").asc(),
    ]


def rerank_minmax(
    candidates: DataFrame, by: str = "user_id", weights: dict[str, float] | None = None, novelty: float = 0.0
) -> DataFrame:
    """Min-max scaled similarity, popularity (or its opposite) and quality, blended."""
    if not 0 <= novelty <= 1:
        raise ValueError("novelty must be between 0 and 1")
    share = shares(weights or RERANK_WEIGHTS)
    quality = quality_source(candidates.columns)
    scaled = lambda c: minmax_scale(c, [by])
    scored = candidates.withColumns(
        {
            "similarity_component": scaled("hybrid_similarity"),
            "popularity_component": scaled(log_popularity()) if "ratings_count" in candidates.columns else F.lit(0.0),
            "quality_component": scaled(quality) if quality else F.lit(0.0),
        }
    ).withColumn("novelty_component", 1 - F.col("popularity_component"))
    taste = F.lit(1 - novelty) * F.col("popularity_component") + F.lit(novelty) * F.col("novelty_component")
    score = (
        F.lit(share["similarity"]) * F.col("similarity_component")
        + F.lit(share["popularity"]) * taste
        + F.lit(share["quality"]) * F.col("quality_component")
    )
    # scores are compared at 9 decimals, like the similarities they come from
    return scored.withColumn("recommendation_score", F.round(score, 9))


def author_cap(ranked: DataFrame, by: str = "user_id", max_per_author: int = 3) -> DataFrame:
    """At most ``max_per_author`` rows per user and author, best first; 0 keeps all."""
    if max_per_author <= 0:
        return ranked
    author = F.trim(F.coalesce(F.when(F.col("primary_author") != "", F.col("primary_author")), F.lit("Unknown")))
    keyed = ranked.withColumn("_author", F.lower(author))
    return top_k(keyed, [by, "_author"], rerank_order(), max_per_author, "_rank").drop("_author", "_rank")


def output_rank(ranked: DataFrame, by: str = "user_id", top: int = 50) -> DataFrame:
    return top_k(ranked, [by], rerank_order(), top, "rank")


def recommendation_reason(similarity="hybrid_similarity", genre="primary_genre", quality="bayesian_rating", average="average_rating") -> Column:
    # format_number rounds the exact binary value half-even
    fixed = lambda c, p: F.expr(f"format_number({c}, '{p}')")
    rating = F.expr(f"format_number(coalesce({quality}, {average}), '0.00')")
    return F.concat_ws(
        "; ",
        F.concat(F.lit("hybrid similarity "), fixed(similarity, "0.000")),
        F.when(F.trim(genre) != "", F.concat(F.lit("genre: "), F.col(genre))),
        F.concat(F.lit("rating "), rating),
    )


def recommend(
    profiles: DataFrame,
    vectors: DataFrame,
    catalog: DataFrame,
    exclusions: DataFrame,
    pool: int = 1000,
    top: int = 50,
    weights: dict[str, float] | None = None,
    novelty: float = 0.0,
    max_per_author: int = 3,
    by: str = "user_id",
    by_work: bool = True,
    **filters,
) -> DataFrame:
    """The ranked recommendations of every profile.

    ``profiles`` has the user and a vector, ``vectors`` book_id and a vector of the
    same space, ``exclusions`` the user's local_book_id and work_id.

    The pool holds each reader's ``pool`` nearest books among those that may be recommended: the filters cut the vectors
    before the search, and the search finds as many books more as the reader has excluded ones. So a reader with many
    known books or a narrow filter gets ``top`` rows wherever there are so many.
    """
    if pool < top:
        raise ValueError("the candidate pool must be at least as large as the result")
    open_ = id_semi_filter(vectors, candidate_filters(catalog, **filters), "book_id") if filters else vectors
    # the search reads its queries several times: the excluded books are counted once
    asked = cut_lineage(profiles.select(by, "vector").join(excluded_counts(open_, catalog, exclusions, by, by_work), by, "left"))
    found = knn_topk(asked, open_, pool, by, extra="_excluded").withColumnRenamed("similarity", "hybrid_similarity")
    known = exclusion_anti_join(candidate_join(found.drop("rank"), catalog), exclusions, by, by_work)
    candidates = top_k(known, [by], [F.col("hybrid_similarity").desc(), F.col("book_id").asc()], pool, "_place").drop("_place")
    ranked = rerank_minmax(candidates, by, weights, novelty)
    best = output_rank(author_cap(ranked, by, max_per_author), by, top)
    missing = [c for c in ("bayesian_rating", "average_rating") if c not in best.columns]
    for column in missing:
        best = best.withColumn(column, F.lit(None).cast("double"))
    return best.withColumn("recommendation_reason", recommendation_reason()).drop(*missing)


def cold_start_recommend(
    texts: DataFrame,
    tfidf: TfidfModel,
    svd: SvdModel,
    content: DataFrame,
    scored: DataFrame,
    k: int = 50,
    weights: dict[str, float] | None = None,
    key: str = "input_id",
) -> DataFrame:
    """Neighbours of texts unknown to the catalog: embed, find, rerank by percentiles.

    ``texts`` has the key and content_text, ``scored`` book_id with the two percentiles.
    """
    # the search counts and reads both sides several times: the texts are tokenized and projected once
    queries = cut_lineage(svd_project(svd, tfidf_transform(tfidf, texts, key), key))
    near = knn_topk(queries, cut_lineage(content), k, key)
    joined = near.join(scored.select("book_id", "popularity_percentile", "novelty_percentile"), "book_id", "left")
    part = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    score = percentile_rerank("similarity", part("popularity_percentile"), part("novelty_percentile"), weights)
    rescored = joined.withColumn("final_score", F.round(score, 9)).drop("rank")
    return top_k(rescored, [key], [F.col("final_score").desc(), F.col("book_id").asc()], k, "rank")
