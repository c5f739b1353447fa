"""Popularity scores and ranked lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lectern.functions.scoring import bayesian_rating, wilson_lower_bound
from lectern.operators.catalog import scoring_literals
from lectern.operators.ranking import cume_dist, grouped_quantile, top_k, top_n

# Columns of the scored table.
SCORED_COLUMNS = (
    "book_id", "work_id", "interaction_book_id", "title", "primary_author_id", "primary_author", "author_names",
    "primary_genre", "genre_names", "language_code", "publication_year", "average_rating", "ratings_count",
    "text_reviews_count", "is_canonical_edition", "novelty_score", "image_url",
)


def scored_books_join(catalog: DataFrame, items: DataFrame) -> DataFrame:
    """Canonical editions with the observed statistics of their item."""
    observed = items.select(
        F.col("item_id").alias("_item"),
        "interaction_count",
        F.col("rating_count").alias("observed_rating_count"),
        "average_user_rating",
    )
    canonical = catalog.where(F.col("is_canonical_edition"))
    return canonical.join(observed, F.col("interaction_book_id") == F.col("_item"), "left").drop("_item")


def score_books(
    catalog: DataFrame, items: DataFrame, confidence: float = 0.95, quantile: float = 0.90
) -> DataFrame:
    """Bayesian and Wilson scores of every canonical edition."""
    mean, votes = scoring_literals(catalog, quantile)
    joined = scored_books_join(catalog, items)
    kept = [c for c in SCORED_COLUMNS if c in joined.columns]
    return joined.select(
        *kept,
        "interaction_count",
        "observed_rating_count",
        "average_user_rating",
        bayesian_rating("average_rating", "ratings_count", mean, votes).alias("bayesian_score"),
        wilson_lower_bound("average_user_rating", "observed_rating_count", confidence).alias("wilson_score"),
    )


def _popular():
    return [
        F.col("bayesian_score").desc_nulls_last(),
        F.col("wilson_score").desc_nulls_last(),
        F.col("ratings_count").desc_nulls_last(),
        F.col("book_id").asc(),
    ]


def _enough(min_ratings: int):
    return F.coalesce("ratings_count", F.lit(0)) >= min_ratings


def rank_overall(scored: DataFrame, top: int = 1000, min_ratings: int = 50) -> DataFrame:
    return top_n(scored.where(_enough(min_ratings)), _popular(), top, "rank")


def rank_by(scored: DataFrame, key: str, out: str, top: int = 100, min_ratings: int = 20) -> DataFrame:
    known = F.col(key).isNotNull() & _enough(min_ratings)
    return top_k(scored.where(known), [key], _popular(), top, out)


def rank_by_genre(scored: DataFrame, top: int = 100, min_ratings: int = 20) -> DataFrame:
    return rank_by(scored, "primary_genre", "genre_rank", top, min_ratings)


def rank_by_language(scored: DataFrame, top: int = 100, min_ratings: int = 20) -> DataFrame:
    spoken = scored.where(F.trim("language_code") != "")
    return rank_by(spoken, "language_code", "language_rank", top, min_ratings)


def hidden_gems(
    scored: DataFrame, min_rating: float = 4.2, low: int = 50, high: int = 500, top: int = 1000
) -> DataFrame:
    """Well rated books few people know."""
    order = [
        F.col("wilson_score").desc_nulls_last(),
        F.col("bayesian_score").desc_nulls_last(),
        F.col("novelty_score").desc_nulls_last(),
        F.col("ratings_count").asc(),
        F.col("book_id").asc(),
    ]
    kept = (F.col("average_rating") >= min_rating) & F.col("ratings_count").between(low, high)
    return top_n(scored.where(kept), order, top, "hidden_gem_rank")


def safe_choices(scored: DataFrame, min_rating: float = 4.1, min_count: int = 50_000, top: int = 1000) -> DataFrame:
    """Well rated books very many people know."""
    order = [
        F.col("wilson_score").desc_nulls_last(),
        F.col("bayesian_score").desc_nulls_last(),
        F.col("ratings_count").desc_nulls_last(),
        F.col("book_id").asc(),
    ]
    kept = (F.col("average_rating") >= min_rating) & (F.col("ratings_count") >= min_count)
    return top_n(scored.where(kept), order, top, "safe_choice_rank")


def author_rankings(scored: DataFrame, min_books: int = 2) -> DataFrame:
    """Per-author aggregates; the best book ties on the lowest id.

    The median comes from counts per distinct rating, so that an author holding a
    large share of all books is no single group.
    """
    author = ["primary_author_id", "primary_author"]
    books = scored.where(F.col(author[0]).isNotNull() & F.col(author[1]).isNotNull())
    named = F.col("title").isNotNull() & F.col("bayesian_score").isNotNull()
    best = F.max_by(F.when(named, F.col("title")), F.when(named, F.struct("bayesian_score", -F.col("book_id"))))
    stats = (
        books.groupBy(*author)
        .agg(
            F.count("*").alias("canonical_book_count"),
            F.sum(F.coalesce("ratings_count", F.lit(0))).alias("total_ratings"),
            F.avg("average_rating").alias("mean_rating"),
            F.avg("bayesian_score").alias("mean_bayesian_score"),
            F.avg("wilson_score").alias("mean_wilson_score"),
            F.max("bayesian_score").alias("best_book_bayesian_score"),
            best.alias("best_ranked_book"),
        )
        .where(F.col("canonical_book_count") >= min_books)
    )
    medians = grouped_quantile(books, author, "average_rating", 0.5, "median_rating")
    return stats.join(medians, author, "left")


def percentiles(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Global CUME_DIST (nulls first) of each source column under its new name."""
    for source, out in columns.items():
        df = cume_dist(df, source, out)
    return df
