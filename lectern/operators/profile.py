"""User profiles: weighted rows, vectors and favourites, for all users at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lectern.functions.scoring import recency_decay, shares
from lectern.functions.vectors import concat_scaled
from lectern.operators.ranking import top_k
from lectern.operators.similarity import embedding_gather, weighted_vector_sum


def profile_rows(
    imported: DataFrame,
    reference_date,
    half_life_days: float = 0.0,
    min_weight: float = 0.05,
    positive_only: bool = False,
    date: str = "date_read",
    fallback: str = "date_added",
) -> DataFrame:
    """Eligible, matched rows whose weight clears ``min_weight`` before and after decay.

    A row without a reading date decays from the date it was added, if the rows have one.
    """
    rows = imported
    if "profile_eligible" in rows.columns:
        rows = rows.where(F.coalesce("profile_eligible", F.lit(False)))
    if "match_status" in rows.columns:
        rows = rows.where(F.col("match_status") == "matched")
    base = F.coalesce(F.col("preference_weight").cast("double"), F.lit(0.0))
    rows = rows.withColumn("base_weight", base)
    strong = F.col("base_weight") if positive_only else F.abs("base_weight")
    kept = rows.where((strong >= min_weight) & (F.col("base_weight") > 0 if positive_only else F.lit(True)))
    dates = [F.col(c).cast("date") for c in (date, fallback) if c in rows.columns]
    when = F.coalesce(*dates) if dates else F.lit(None).cast("date")
    return (
        kept.withColumn("recency_multiplier", recency_decay(when, reference_date, half_life_days))
        .withColumn("effective_weight", F.col("base_weight") * F.col("recency_multiplier"))
        .where(F.abs("effective_weight") >= min_weight)
    )


def profile_catalog_join(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    columns = catalog.select(F.col("book_id").alias("local_book_id"), "primary_author", "primary_genre")
    return rows.join(columns, "local_book_id", "left")


def profile_sources(rows: DataFrame, vectors: DataFrame, space: str) -> DataFrame:
    """Lineage: the profile rows that have a vector in the given space."""
    found = rows.join(vectors.select(F.col("book_id").alias("local_book_id")), "local_book_id", "left_semi")
    return found.select(
        "user_id", "library_row_id", "local_book_id", F.lit(space).alias("space"), "base_weight",
        "recency_multiplier", "effective_weight",
    )


def space_profile(rows: DataFrame, vectors: DataFrame) -> DataFrame:
    """Weighted mean direction per user in one embedding space."""
    keyed = vectors.select(F.col("book_id").alias("local_book_id"), "vector")
    with_vectors = embedding_gather(rows.select("user_id", "local_book_id", "effective_weight"), keyed, "local_book_id")
    return weighted_vector_sum(with_vectors, "user_id", "effective_weight", "vector")


def user_profile(
    rows: DataFrame,
    content: DataFrame,
    collaborative: DataFrame,
    content_weight: float = 0.5,
    collaborative_weight: float = 0.5,
) -> DataFrame:
    """Content, collaborative and hybrid vector per user that has both."""
    share = shares({"content": content_weight, "collaborative": collaborative_weight})
    left = space_profile(rows, content).select("user_id", F.col("vector").alias("content_vector"))
    right = space_profile(rows, collaborative).select(
        "user_id", F.col("vector").alias("collaborative_vector")
    )
    vector = concat_scaled("content_vector", share["content"], "collaborative_vector", share["collaborative"])
    return left.join(right, "user_id").withColumn("vector", vector)


def _favorites(rows: DataFrame, catalog: DataFrame, column: str, top: int) -> DataFrame:
    liked = profile_catalog_join(rows.where(F.col("effective_weight") > 0), catalog).where(F.col(column).isNotNull())
    sums = liked.groupBy("user_id", column).agg(
        F.sum("effective_weight").alias("weighted_preference"), F.count_distinct("local_book_id").alias("books")
    )
    # sums are compared at 9 decimals: the order of additions must not decide a rank
    order = [F.round("weighted_preference", 9).desc(), F.col("books").desc(), F.col(column).asc()]
    return top_k(sums, ["user_id"], order, top, "rank")


def favorite_authors(rows: DataFrame, catalog: DataFrame, top: int = 30) -> DataFrame:
    return _favorites(rows, catalog, "primary_author", top)


def favorite_genres(rows: DataFrame, catalog: DataFrame, top: int = 30) -> DataFrame:
    return _favorites(rows, catalog, "primary_genre", top)


def profile_statistics(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id").agg(
        F.count("*").alias("profile_rows_used"),
        F.count_if(F.col("effective_weight") > 0).alias("positive_rows"),
        F.count_if(F.col("effective_weight") < 0).alias("negative_rows"),
        F.avg("effective_weight").alias("mean_effective_weight"),
        F.sum(F.abs("effective_weight")).alias("absolute_weight_sum"),
    )
