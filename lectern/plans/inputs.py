"""Input views over the given tables, and the registry of queries and their SQL.

A view is one SELECT that both engines understand; ``{name}`` stands for a given
table. The same text feeds ``spark.sql`` and, as a WITH chain, the check SQL.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.session import shared_dir, ship_package, tune

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {
    # user-item edges: readers are customers, books are parts
    "interactions": """
        SELECT o_custkey AS user_id, l_partkey AS book_id,
               CAST(CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END AS TINYINT) AS is_read,
               CAST(CAST(l_quantity AS INT) % 6 AS TINYINT) AS rating,
               CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS TINYINT) AS is_reviewed
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "book_ratings": """
        SELECT book_id, CAST(COUNT(*) AS BIGINT) AS ratings_count, AVG(CAST(rating AS DOUBLE)) AS average_rating,
               CAST(SUM(CAST(is_reviewed AS INT)) AS BIGINT) AS text_reviews_count
        FROM interactions WHERE rating > 0 GROUP BY book_id""",
    # editions: three per work, some without work, language or interaction id
    "books": """
        SELECT p_partkey AS book_id,
               CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(FLOOR(p_partkey / 3) AS BIGINT) END AS work_id,
               p_name AS title, p_brand AS primary_author,
               CAST(regexp_extract(p_brand, '[0-9]+', 0) AS BIGINT) AS primary_author_id,
               p_type AS primary_genre, 1950 + p_size AS publication_year,
               CASE p_size % 4 WHEN 0 THEN 'en-US' WHEN 1 THEN 'fre' WHEN 2 THEN 'ger' ELSE NULL END AS language_code,
               average_rating, ratings_count, text_reviews_count,
               CASE WHEN p_partkey % 20 <> 7 THEN p_partkey END AS interaction_book_id
        FROM {part} LEFT JOIN book_ratings ON p_partkey = book_id""",
    "documents_v": """
        SELECT doc_id AS book_id, t.title, source AS primary_author, lang AS language_code,
               text AS description, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE concat('genre ', lang, ' | ', source) END AS genre_names,
               lang AS primary_genre, CAST(1950 + n_chars % 70 AS INT) AS publication_year,
               doc_id % 5 <> 0 AS is_canonical_edition,
               CASE WHEN doc_id % 20 <> 7 THEN doc_id END AS interaction_book_id
        FROM (SELECT *, doc_id % (SELECT COUNT(*) FROM {pages}) AS title_id FROM {documents}) d
        LEFT JOIN (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM {pages}) t ON t.page_id = d.title_id""",
    # library rows of many readers
    "library": """
        SELECT l.event_id AS library_row_id, l.user_id, l.local_book_id, p_name AS input_title, p_brand AS input_author,
               CASE l.event_type WHEN 'purchase' THEN 'read' WHEN 'click' THEN 'read'
                    WHEN 'view' THEN 'currently-reading' WHEN 'signup' THEN 'to-read' ELSE 'dropped' END AS exclusive_shelf,
               CAST(FLOOR(l.value) AS INT) % 6 AS my_rating, CAST(1 + l.event_id % 3 AS INT) AS read_count,
               CAST(l.ts AS DATE) AS date_read
        FROM (SELECT *, event_id % (SELECT COUNT(*) FROM {embeddings}) AS local_book_id,
                     event_id % (SELECT COUNT(*) FROM {part}) AS part_id FROM {events}) l
        JOIN {part} ON p_partkey = l.part_id""",
    # the books of the library, with vectors: descriptive columns by vector id
    "shelf_books": """
        SELECT vec_id AS book_id, CAST(FLOOR(vec_id / 2) AS BIGINT) AS work_id, p_name AS title,
               p_brand AS primary_author, p_type AS primary_genre,
               CASE p_size % 3 WHEN 0 THEN 'en-US' WHEN 1 THEN 'fre' ELSE NULL END AS language_code,
               r.ratings_count, r.average_rating
        FROM {embeddings} JOIN {part} ON p_partkey = vec_id LEFT JOIN book_ratings r ON r.book_id = vec_id""",
}
# the order in which views build on each other
ORDER = tuple(VIEWS)


def _names_in(text: str) -> set[str]:
    return set(re.findall(r"\b\w+\b", text))


def chain(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind a WITH clause of the views (and extra steps) it reaches."""
    steps = {**VIEWS, **(extra or {})}
    needed, queue = set(), [body]
    while queue:
        for name in _names_in(queue.pop()) & steps.keys() - needed:
            needed.add(name)
            queue.append(steps[name])
    listed = [f"{name} AS ({steps[name]})" for name in steps if name in needed]
    return f"WITH {', '.join(listed)} {body}" if listed else body


def check_sql(body: str, extra: dict[str, str] | None = None) -> str:
    text = chain(body, extra)
    for table in TABLES:
        text = text.replace("{" + table + "}", table)
    return text


class Inputs:
    """The given tables and views of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir.rstrip("/")
        ship_package(spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        text = chain(f"SELECT * FROM {name}")
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)


def place(inp: Inputs, name: str) -> str:
    """A new path in the folder the cluster shares."""
    return f"{shared_dir(inp.spark)}/tables/{uuid.uuid4().hex}/{name}"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, steps: dict[str, str] | None = None):
    """Register a query of the inputs, with its check SQL where SQL can say it."""

    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        if sql is not None:
            CHECKS[name] = check_sql(sql, steps)
        return build

    return register


def r6(value: Column | str) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    return F.round(F.col(value) if isinstance(value, str) else value, 6) + F.lit(0.0)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def big(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})
