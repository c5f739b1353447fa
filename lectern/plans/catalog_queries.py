"""Catalog: bridges, summaries, editions, derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import scoring, text
from lectern.operators import catalog as ops
from lectern.plans.inputs import Inputs, query, r6, rounded
from lectern.session import cut_lineage

# author ids of brands start here, above every supplier and above what a double holds exactly
BRAND_IDS = 2**53 + 1

CATALOG_SQL = {
    "parameters": """SELECT COALESCE(AVG(average_rating), 0) AS global_mean_rating,
        GREATEST(COALESCE(QUANTILE_CONT(CAST(ratings_count AS DOUBLE), 0.9), 1), 1) AS minimum_votes
        FROM books WHERE average_rating BETWEEN 0 AND 5 AND ratings_count > 0""",
    "editions": """SELECT book_id, COALESCE(work_id, -book_id) AS work_key, ROW_NUMBER() OVER (
        PARTITION BY COALESCE(work_id, -book_id) ORDER BY COALESCE(ratings_count, 0) DESC,
        COALESCE(text_reviews_count, 0) DESC, book_id) AS edition_rank FROM books""",
    "catalog_c": """SELECT b.*, edition_rank, edition_rank = 1 AS is_canonical_edition,
        ratings_count / (ratings_count + minimum_votes) * average_rating
        + minimum_votes / (ratings_count + minimum_votes) * global_mean_rating AS bayesian_rating,
        LOWER(REGEXP_REPLACE(TRIM(COALESCE(title, '')), '[^[:alnum:]]+', ' ', 'g')) AS title_key,
        CASE WHEN ratings_count > 0 THEN 1.0 / LN(ratings_count + EXP(1)) ELSE 1.0 END AS novelty_score
        FROM books b JOIN editions USING (book_id) CROSS JOIN parameters""",
    # nested inputs, as the rows the bridges must give
    "part_suppliers": "SELECT DISTINCT l_partkey AS book_id, l_suppkey AS author_id FROM {lineitem}",
    "author_entries": f"""SELECT p_partkey AS book_id, {BRAND_IDS} + CAST(regexp_extract(p_brand, '[0-9]+', 0) AS BIGINT) AS author_id,
        CAST(NULL AS VARCHAR) AS author_role, 0 AS author_position FROM {{part}}
        UNION ALL SELECT book_id, author_id, CASE author_id % 3 WHEN 0 THEN 'Translator' WHEN 1 THEN 'Editor' END,
        CAST(ROW_NUMBER() OVER (PARTITION BY book_id ORDER BY author_id) AS INT)
        FROM part_suppliers JOIN {{part}} ON p_partkey = book_id""",
    "author_names": f"""SELECT s_suppkey AS author_id, CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE s_name END AS name FROM {{supplier}}
        UNION ALL SELECT DISTINCT {BRAND_IDS} + CAST(regexp_extract(p_brand, '[0-9]+', 0) AS BIGINT), p_brand FROM {{part}}""",
    "author_rows": """SELECT book_id, author_id, COALESCE(NULLIF(name, ''), 'Unknown author') AS author_name, author_role, author_position
        FROM author_entries LEFT JOIN author_names USING (author_id)""",
    "genre_entries": """SELECT p_partkey AS book_id, p_type AS genre_name, CAST(p_size AS BIGINT) AS genre_count FROM {part}
        UNION ALL SELECT p_partkey, split_part(p_name, ' ', 1), CAST(p_size % 7 AS BIGINT) FROM {part}
        UNION ALL SELECT p_partkey, split_part(p_name, ' ', 2), 0 FROM {part}""",
    "genre_rows": """SELECT *, ROW_NUMBER() OVER (PARTITION BY book_id ORDER BY genre_count DESC, genre_name) AS genre_rank
        FROM genre_entries""",
    "author_sums": """SELECT book_id, STRING_AGG(author_name, ', ' ORDER BY author_position, author_name) AS author_names,
        ARG_MIN(author_name, author_position) AS primary_author, ARG_MIN(author_id, author_position) AS primary_author_id,
        COUNT(*) AS author_count FROM author_rows GROUP BY book_id""",
    "genre_sums": """SELECT book_id, STRING_AGG(genre_name, ' | ' ORDER BY genre_rank, genre_name) AS genre_names,
        ARG_MIN(genre_name, genre_rank) AS primary_genre, COUNT(*) AS genre_count FROM genre_rows GROUP BY book_id""",
}


def catalog(inp: Inputs):
    """The books view as a stored catalog, through the edition and scoring operators."""
    books = cut_lineage(inp.view("books"))
    ranked = books.join(ops.edition_rank(books).select("book_id", "edition_rank"), "book_id").withColumns(
        {"is_canonical_edition": F.col("edition_rank") == 1, "title_without_series": F.lit(None).cast("string"),
         "description": F.lit(None).cast("string")}
    )
    return cut_lineage(ops.derived_columns(ranked, *ops.scoring_literals(books)).drop("title_without_series"))


def nested_books(inp: Inputs):
    """Raw edition rows with a native author array: the brand, then the part's suppliers."""
    brand = F.lit(BRAND_IDS) + F.regexp_extract("p_brand", "[0-9]+", 0).cast("bigint")
    author = lambda i, role: F.struct(i.cast("string").alias("author_id"), role.alias("role"))
    suppliers = inp.table("lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_set("l_suppkey")).alias("_s"))
    role = lambda s: F.when(s % 3 == 0, "Translator").when(s % 3 == 1, "Editor").otherwise("")
    others = F.transform(F.coalesce("_s", F.array().cast("array<bigint>")), lambda s: author(s, role(s)))
    part = inp.table("part").join(suppliers, F.col("p_partkey") == F.col("l_partkey"), "left")
    authors = part.select(
        F.col("p_partkey").alias("book_id"), F.concat(F.array(author(brand, F.lit(""))), others).alias("authors")
    )
    text_id = lambda c: F.col(c).cast("string")
    books = inp.view("books").join(authors, "book_id")
    raw = books.select(
        text_id("book_id").alias("book_id"), text_id("work_id").alias("work_id"),
        F.concat(F.lit("  "), "title", F.lit(" ")).alias("title"), F.lit("").alias("title_without_series"),
        F.concat("title", F.lit(": "), "primary_author", F.lit(", "), "primary_genre").alias("description"),
        text_id("average_rating").alias("average_rating"), text_id("ratings_count").alias("ratings_count"),
        text_id("text_reviews_count").alias("text_reviews_count"), text_id("publication_year").alias("publication_year"),
        "language_code", "authors",
        *(F.lit(None).cast("string").alias(c) for c in ("publisher", "isbn", "isbn13", "url", "image_url")),
    )
    return cut_lineage(raw)


def author_table(inp: Inputs):
    supplier = inp.table("supplier").select(
        F.col("s_suppkey").cast("string").alias("author_id"),
        F.when(F.col("s_suppkey") % 7 == 0, "").otherwise(F.col("s_name")).alias("name"),
    )
    brands = inp.table("part").select(
        (F.lit(BRAND_IDS) + F.regexp_extract("p_brand", "[0-9]+", 0).cast("bigint")).cast("string").alias("author_id"),
        F.col("p_brand").alias("name"),
    )
    return supplier.unionByName(brands.distinct())


def genre_table(inp: Inputs):
    """Genre counts as a native map; one key is padded, one blank, one count missing."""
    word = lambda n: F.split_part("p_name", F.lit(" "), F.lit(n))
    return inp.table("part").select(
        F.col("p_partkey").cast("string").alias("book_id"),
        F.map_from_arrays(
            F.array(F.concat("p_type", F.lit(" ")), word(1), word(2), F.lit("  ")),
            F.array(F.col("p_size").cast("string"), (F.col("p_size") % 7).cast("string"), F.lit(None).cast("string"), F.lit("9")),
        ).alias("genres"),
    )


def work_table(inp: Inputs):
    return (
        inp.view("books").where(F.col("work_id").isNotNull()).groupBy(F.col("work_id").cast("string").alias("work_id"))
        .agg(
            F.count("*").alias("books_count"), F.sum("ratings_count").alias("ratings_count"),
            F.min("title").alias("original_title"), F.min("publication_year").alias("original_publication_year"),
        )
        .withColumns({f"original_publication_{p}": F.lit(None).cast("int") for p in ("month", "day")})
    )


def id_map(inp: Inputs):
    mapped = inp.view("books").where(F.col("interaction_book_id").isNotNull())
    return mapped.select(F.col("interaction_book_id").alias("book_id_csv"), F.col("book_id").cast("string").alias("book_id"))


def bridge(inp: Inputs):
    return ops.author_bridge_join(ops.author_bridge(nested_books(inp)), author_table(inp))


@query("author_bridge", "SELECT book_id, author_id, author_role, author_position FROM author_entries", CATALOG_SQL)
def author_bridge(inp):
    return ops.author_bridge(nested_books(inp))


@query("author_bridge_join", "SELECT * FROM author_rows", CATALOG_SQL)
def author_bridge_join(inp):
    return bridge(inp)


@query("genre_bridge", "SELECT book_id, genre_name, genre_count FROM genre_entries", CATALOG_SQL)
def genre_bridge(inp):
    return ops.genre_entries(genre_table(inp))


@query("genre_rank", "SELECT book_id, genre_name, genre_count, genre_rank FROM genre_rows", CATALOG_SQL)
def genre_rank(inp):
    return ops.genre_bridge(genre_table(inp))


@query("author_summary", "SELECT * FROM author_sums", CATALOG_SQL)
def author_summary(inp):
    return ops.author_summary(bridge(inp))


@query("genre_summary", "SELECT * FROM genre_sums", CATALOG_SQL)
def genre_summary(inp):
    return ops.genre_summary(ops.genre_bridge(genre_table(inp)))


@query("edition_rank", "SELECT book_id, work_key, edition_rank FROM editions", CATALOG_SQL)
def edition_rank(inp):
    return ops.edition_rank(inp.view("books"))


@query("is_canonical_edition", "SELECT book_id, edition_rank = 1 AS is_canonical_edition FROM editions", CATALOG_SQL)
def is_canonical_edition(inp):
    return catalog(inp).select("book_id", "is_canonical_edition")


@query("scoring_parameters", "SELECT ROUND(global_mean_rating, 6) AS global_mean_rating, ROUND(minimum_votes, 6) AS minimum_votes FROM parameters", CATALOG_SQL)
def scoring_parameters(inp):
    return rounded(ops.scoring_parameters(inp.view("books")), "global_mean_rating", "minimum_votes")


@query("bayesian_rating", "SELECT book_id, ROUND(bayesian_rating, 6) AS bayesian_rating FROM catalog_c", CATALOG_SQL)
def bayesian_rating(inp):
    return catalog(inp).select("book_id", r6("bayesian_rating").alias("bayesian_rating"))


@query("novelty_score", "SELECT book_id, ROUND(novelty_score, 6) AS novelty_score FROM catalog_c", CATALOG_SQL)
def novelty_score(inp):
    return inp.view("books").select("book_id", r6(scoring.novelty_score("ratings_count")).alias("novelty_score"))


@query(
    "title_key",
    """SELECT doc_id, LOWER(REGEXP_REPLACE(TRIM(COALESCE(text, source, '')), '[^[:alnum:]]+', ' ', 'g')) AS title_key FROM {documents}""",
)
def title_key(inp):
    return inp.table("documents").select("doc_id", text.title_key("text", "source").alias("title_key"))


@query("has_usable_description", "SELECT book_id, COALESCE(LENGTH(description) >= 200, FALSE) AS has_usable_description FROM documents_v")
def has_usable_description(inp):
    return inp.view("documents_v").select(
        "book_id", text.has_usable_description("description", 200).alias("has_usable_description")
    )


@query(
    "try_cast",
    """SELECT event_id, CAST(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS DOUBLE) AS as_double,
    TRY_CAST(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS BIGINT) IS NULL AS no_number,
    TRY_CAST(event_type AS BIGINT) AS no_integer, CAST(ROUND(value) AS BIGINT) AS as_integer FROM {events}""",
)
def try_cast(inp):
    return inp.table("events").select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("double").alias("as_double"),
        text.whole_number(F.col("value").cast("string")).isNull().alias("no_number"),
        text.whole_number("event_type").alias("no_integer"),
        text.whole_number(F.col("value").cast("string")).alias("as_integer"),
    )


@query("blank_to_null", "SELECT conv_id, turn, NULLIF(TRIM(text), '') AS text FROM {conversations}")
def blank_to_null(inp):
    return inp.table("conversations").select("conv_id", "turn", text.blank_to_null("text").alias("text"))


@query("coalesce_default", "SELECT book_id, COALESCE(work_id, -book_id) AS work_key, COALESCE(ratings_count, 0) AS ratings_count, COALESCE(language_code, 'unknown') AS language_code FROM books")
def coalesce_default(inp):
    return inp.view("books").select(
        "book_id",
        F.coalesce("work_id", -F.col("book_id")).alias("work_key"),
        F.coalesce("ratings_count", F.lit(0)).alias("ratings_count"),
        F.coalesce("language_code", F.lit("unknown")).alias("language_code"),
    )


@query("range_predicates", "SELECT book_id FROM books WHERE average_rating BETWEEN 2.5 AND 3.5 AND ratings_count >= 15 AND language_code IS NOT NULL AND TRIM(title) <> ''")
def range_predicates(inp):
    kept = F.col("average_rating").between(2.5, 3.5) & (F.col("ratings_count") >= 15)
    return inp.view("books").where(kept & F.col("language_code").isNotNull() & (F.trim("title") != "")).select("book_id")


@query(
    "multi_key_sort",
    """SELECT book_id, ROW_NUMBER() OVER (ORDER BY average_rating DESC NULLS LAST, ratings_count DESC NULLS LAST, book_id) AS position
    FROM books""",
)
def multi_key_sort(inp):
    from lectern.operators.ranking import rank_rows

    order = [F.col("average_rating").desc_nulls_last(), F.col("ratings_count").desc_nulls_last(), F.col("book_id").asc()]
    return rank_rows(inp.view("books"), [], order, "position").select("book_id", "position")


_STAR = """SELECT b.book_id, b.work_id, title, average_rating_r AS average_rating, b.ratings_count, a.primary_author_id,
    a.primary_author, a.author_names, a.author_count, g.primary_genre, g.genre_names, g.genre_count,
    CAST(b.interaction_book_id AS BIGINT) AS interaction_book_id, w.work_books_count, w.work_ratings_count, w.original_title,
    w.original_publication_year, e.edition_rank, e.edition_rank = 1 AS is_canonical_edition,
    ROUND(c.bayesian_rating, 6) AS bayesian_rating, c.title_key, ROUND(c.novelty_score, 6) AS novelty_score,
    LENGTH(b.title || ': ' || b.primary_author || ', ' || b.primary_genre) >= 40 AS has_usable_description
    FROM (SELECT *, ROUND(average_rating, 6) AS average_rating_r FROM books) b
    LEFT JOIN author_sums a ON a.book_id = b.book_id LEFT JOIN genre_sums g ON g.book_id = b.book_id
    LEFT JOIN editions e ON e.book_id = b.book_id LEFT JOIN catalog_c c ON c.book_id = b.book_id
    LEFT JOIN (SELECT work_id, COUNT(*) AS work_books_count, CAST(SUM(ratings_count) AS BIGINT) AS work_ratings_count,
        MIN(title) AS original_title, MIN(publication_year) AS original_publication_year FROM books
        WHERE work_id IS NOT NULL GROUP BY work_id) w ON w.work_id = b.work_id"""


@query("catalog_star_join", _STAR.replace("SELECT b.book_id, b.work_id, title,", "SELECT b.book_id, b.work_id, b.title,"), CATALOG_SQL)
def catalog_star_join(inp):
    full = ops.build_catalog(nested_books(inp), author_table(inp), genre_table(inp), work_table(inp), id_map(inp))
    shown = full.select(
        "book_id", "work_id", "title", "average_rating", "ratings_count", "primary_author_id", "primary_author",
        "author_names", "author_count", "primary_genre", "genre_names", "genre_count", "interaction_book_id",
        "work_books_count", "work_ratings_count", "original_title", "original_publication_year", "edition_rank",
        "is_canonical_edition", "bayesian_rating", "title_key", "novelty_score", "has_usable_description",
    )
    return rounded(shown, "average_rating", "bayesian_rating", "novelty_score")
