"""Bridges, summaries, edition ranks and the one-row-per-edition catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from lectern.functions.scoring import bayesian_rating, novelty_score
from lectern.functions.text import blank_to_null, has_usable_description, title_key, whole_number
from lectern.operators.ranking import SPLIT_ROWS, counted_quantile, rank_rows, value_counts

AUTHORS_TYPE = ArrayType(
    StructType([StructField("author_id", StringType()), StructField("role", StringType())])
)
GENRES_TYPE = MapType(StringType(), StringType())
UNKNOWN_AUTHOR = "Unknown author"


def _native(df: DataFrame, column: str, nested) -> Column:
    """The column itself, or its JSON text read with a fixed type (bad text: null)."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.from_json(column, nested)
    return F.col(column)


def author_bridge(books: DataFrame) -> DataFrame:
    """One row per book and author position; unreadable author lists give none."""
    exploded = books.select(
        whole_number("book_id").alias("book_id"), F.posexplode(_native(books, "authors", AUTHORS_TYPE)).alias("pos", "a")
    )
    role = F.col("a.role").cast("string")
    return exploded.select(
        "book_id",
        whole_number(F.col("a.author_id")).alias("author_id"),
        F.when(role != "", role).alias("author_role"),
        F.col("pos").cast("int").alias("author_position"),
    )


def author_bridge_join(bridge: DataFrame, authors: DataFrame) -> DataFrame:
    """Names on the bridge; rows without a book or author id are dropped.

    The bridge is the left side, so the adaptive planner may split a hot author.
    """
    names = authors.select(whole_number("author_id").alias("author_id"), F.col("name").alias("_name"))
    name = F.coalesce(F.when(F.col("_name") != "", F.col("_name")), F.lit(UNKNOWN_AUTHOR))
    return (
        bridge.where(F.col("book_id").isNotNull() & F.col("author_id").isNotNull())
        .join(names, "author_id", "left")
        .select("book_id", "author_id", name.alias("author_name"), "author_role", "author_position")
    )


def genre_entries(genres: DataFrame) -> DataFrame:
    """Exploded genre counts: trimmed names, null counts as 0, blank names dropped."""
    exploded = genres.select(
        whole_number("book_id").alias("book_id"), F.explode(_native(genres, "genres", GENRES_TYPE)).alias("k", "v")
    )
    return exploded.select(
        "book_id",
        F.trim("k").alias("genre_name"),
        F.coalesce(whole_number("v"), F.lit(0)).cast("bigint").alias("genre_count"),
    ).where(F.col("book_id").isNotNull() & (F.col("genre_name") != ""))


def genre_bridge(genres: DataFrame, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """``genre_entries`` ranked per book by count, then name."""
    order = [F.col("genre_count").desc(), F.col("genre_name").asc()]
    return rank_rows(genre_entries(genres), ["book_id"], order, "genre_rank", split_rows)


def author_summary(bridge: DataFrame) -> DataFrame:
    return bridge.groupBy("book_id").agg(
        F.expr("listagg(author_name, ', ') WITHIN GROUP (ORDER BY author_position, author_name)").alias("author_names"),
        F.min_by("author_name", "author_position").alias("primary_author"),
        F.min_by("author_id", "author_position").alias("primary_author_id"),
        F.count("*").alias("author_count"),
    )


def genre_summary(bridge: DataFrame) -> DataFrame:
    return bridge.groupBy("book_id").agg(
        F.expr("listagg(genre_name, ' | ') WITHIN GROUP (ORDER BY genre_rank, genre_name)").alias("genre_names"),
        F.min_by("genre_name", "genre_rank").alias("primary_genre"),
        F.count("*").alias("genre_count"),
    )


def edition_rank(books: DataFrame, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Editions of a work by ratings, then reviews, then id; a book without a work is its own."""
    book_id = whole_number("book_id")
    narrow = books.select(
        book_id.alias("book_id"),
        F.coalesce(whole_number("work_id"), -book_id).alias("work_key"),
        F.coalesce(whole_number("ratings_count"), F.lit(0)).alias("_ratings"),
        F.coalesce(whole_number("text_reviews_count"), F.lit(0)).alias("_reviews"),
    ).where(F.col("book_id").isNotNull())
    order = [F.col("_ratings").desc(), F.col("_reviews").desc(), F.col("book_id").asc()]
    return rank_rows(narrow, ["work_key"], order, "edition_rank", split_rows).drop("_ratings", "_reviews")


def scoring_parameters(books: DataFrame, quantile: float = 0.90) -> DataFrame:
    """One row: global mean rating and the votes quantile (at least 1)."""
    rated = books.select(
        F.col("average_rating").try_cast("double").alias("rating"),
        F.col("ratings_count").try_cast("double").alias("votes"),
    ).where(F.col("rating").between(0, 5) & (F.col("votes") > 0))
    counts = value_counts(rated, [], "votes", F.sum("rating").alias("_ratings"))
    votes = counted_quantile(counts, [], "votes", quantile, "votes").first()
    minimum = max((votes["votes"] if votes else None) or 1.0, 1.0)
    mean = F.coalesce(F.try_divide(F.sum("_ratings"), F.sum("_n")), F.lit(0.0))
    return counts.agg(mean.alias("global_mean_rating")).withColumn("minimum_votes", F.lit(minimum))


def scoring_literals(books: DataFrame, quantile: float = 0.90) -> tuple[float, float]:
    """The two scoring numbers, for use in expressions."""
    row = scoring_parameters(books, quantile).first()
    return row["global_mean_rating"], row["minimum_votes"]


def base_books(books: DataFrame) -> DataFrame:
    """Typed and trimmed edition columns."""
    blank = lambda *names: [blank_to_null(n).alias(n) for n in names]
    whole = lambda kind, *names: [whole_number(n).try_cast(kind).alias(n) for n in names]
    return books.select(
        *whole("bigint", "book_id", "work_id"),
        *blank("title", "title_without_series", "description"),
        F.col("average_rating").try_cast("double").alias("average_rating"),
        *whole("bigint", "ratings_count", "text_reviews_count"),
        *whole("int", "publication_year"),
        *blank("publisher", "language_code", "isbn", "isbn13", "url", "image_url"),
    ).where(F.col("book_id").isNotNull())


def catalog_star_join(
    books: DataFrame,
    author_summaries: DataFrame,
    genre_summaries: DataFrame,
    id_map: DataFrame,
    works: DataFrame,
    editions: DataFrame,
) -> DataFrame:
    """Five left joins; the four on book_id share one partitioning, works come last."""
    ids = id_map.select(whole_number("book_id").alias("book_id"), whole_number("book_id_csv").alias("interaction_book_id"))
    work = works.select(
        whole_number("work_id").alias("work_id"),
        whole_number("books_count").alias("work_books_count"),
        whole_number("ratings_count").alias("work_ratings_count"),
        blank_to_null("original_title").alias("original_title"),
        *(
            whole_number(f"original_publication_{p}").try_cast("int").alias(f"original_publication_{p}")
            for p in ("year", "month", "day")
        ),
    )
    joined = (
        books.join(author_summaries, "book_id", "left")
        .join(genre_summaries, "book_id", "left")
        .join(ids, "book_id", "left")
        .join(editions.select("book_id", "edition_rank"), "book_id", "left")
        .join(work, "work_id", "left")
    )
    return joined.withColumns(
        {
            "author_count": F.coalesce("author_count", F.lit(0)),
            "genre_count": F.coalesce("genre_count", F.lit(0)),
            "is_canonical_edition": F.col("edition_rank") == 1,
        }
    )


def derived_columns(catalog: DataFrame, mean: float, votes: float, minimum_description: int = 40) -> DataFrame:
    return catalog.withColumns(
        {
            "bayesian_rating": bayesian_rating("average_rating", "ratings_count", mean, votes),
            "title_key": title_key("title_without_series", "title"),
            "novelty_score": novelty_score("ratings_count"),
            "has_usable_description": has_usable_description("description", minimum_description),
        }
    )


def build_catalog(
    books: DataFrame,
    authors: DataFrame,
    genres: DataFrame,
    works: DataFrame,
    id_map: DataFrame,
    quantile: float = 0.90,
) -> DataFrame:
    """Raw tables to the catalog, one row per edition."""
    joined = catalog_star_join(
        base_books(books),
        author_summary(author_bridge_join(author_bridge(books), authors)),
        genre_summary(genre_bridge(genres)),
        id_map,
        works,
        edition_rank(books),
    )
    return derived_columns(joined, *scoring_literals(books, quantile))
