"""Personal library exports: cleaning, matching and the resulting tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.scoring import library_preference_weight
from lectern.functions.text import lenient_date, normalize_isbn, normalize_text, safe_float, safe_int
from lectern.operators.matching import COLD_START, MATCHED, UNMATCHED, match_books
from lectern.operators.ranking import rank_rows, top_k

# Shelves read by default, shelves that shape the profile, shelves
# whose books are never recommended again.
INCLUDED_SHELVES = ("read", "currently-reading", "to-read")
PROFILE_SHELVES = ("read", "currently-reading")
KNOWN_SHELVES = ("read", "currently-reading", "to-read")


def _fold(values: Iterable[str]) -> list[str]:
    return sorted({v.strip().lower() for v in values if v.strip()})


def shelf_filter(
    rows: DataFrame, include: Iterable[str] = INCLUDED_SHELVES, exclude: Iterable[str] = ()
) -> DataFrame:
    """Included exclusive shelf, no excluded custom shelf, and a title."""
    kept = rows.where(F.col("exclusive_shelf").isin(_fold(include)))
    banned = _fold(exclude)
    if banned:
        shelves = F.transform(F.split(F.lower("bookshelves"), ","), lambda s: F.trim(s))
        hit = F.arrays_overlap(shelves, F.array(*(F.lit(b) for b in banned)))
        kept = kept.where(~F.coalesce(hit, F.lit(False)))
    return kept.where(F.length("title") > 0)


def eligibility_flags(rows: DataFrame, profile_shelves: Iterable[str] = PROFILE_SHELVES) -> DataFrame:
    return rows.withColumns(
        {
            "profile_eligible": F.col("exclusive_shelf").isin(_fold(profile_shelves)),
            "exclusion_from_recommendations": F.col("exclusive_shelf").isin(list(KNOWN_SHELVES)),
        }
    )


def library_order() -> list[Column]:
    return [F.col("goodreads_book_id").asc_nulls_last(), F.col("source_row").asc()]


def dedupe_library(rows: DataFrame, by: list[str]) -> DataFrame:
    """First row per reader and (title, author, isbn13, isbn), renumbered from 0."""
    same = [*by, "title_key", "author_key", "isbn13", "isbn"]
    first = top_k(rows, same, library_order(), 1, "_rank").drop("_rank")
    numbered = rank_rows(first, by, library_order(), "library_row_id")
    return numbered.withColumn("library_row_id", F.col("library_row_id") - 1)


def typed_library(export: DataFrame, by: list[str]) -> DataFrame:
    """The export's text columns with their types; missing columns count as empty."""
    text = lambda name: F.trim(F.coalesce(F.col(f"`{name}`"), F.lit(""))) if name in export.columns else F.lit("")
    row = F.col("source_row") if "source_row" in export.columns else F.monotonically_increasing_id()
    return export.select(
        *by,
        row.alias("source_row"),
        safe_int(text("Book Id")).alias("goodreads_book_id"),
        text("Title").alias("title"),
        text("Author").alias("author"),
        text("Additional Authors").alias("additional_authors"),
        normalize_isbn(text("ISBN")).alias("isbn"),
        normalize_isbn(text("ISBN13")).alias("isbn13"),
        F.coalesce(safe_float(text("My Rating")), F.lit(0.0)).alias("my_rating"),
        F.lower(text("Exclusive Shelf")).alias("exclusive_shelf"),
        text("Bookshelves").alias("bookshelves"),
        F.coalesce(safe_int(text("Read Count")), F.lit(0)).cast("int").alias("read_count"),
        lenient_date(text("Date Read")).alias("date_read"),
        lenient_date(text("Date Added")).alias("date_added"),
        safe_int(text("Year Published")).alias("year_published"),
        safe_int(text("Original Publication Year")).alias("original_publication_year"),
    )


def clean_library(
    export: DataFrame,
    by: list[str],
    include: Iterable[str] = INCLUDED_SHELVES,
    profile_shelves: Iterable[str] = PROFILE_SHELVES,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Typed, filtered, weighted and deduplicated library rows per reader (``by``)."""
    kept = eligibility_flags(shelf_filter(typed_library(export, by), include, exclude), profile_shelves)
    keyed = kept.withColumns(
        {
            "preference_weight": library_preference_weight(),
            "title_key": normalize_text("title"),
            "author_key": normalize_text("author"),
        }
    )
    return dedupe_library(keyed, by)


def resume_anti_join(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a stored result yet."""
    return rows.join(done.select(*keys), keys, "left_anti")


def import_library(
    cleaned: DataFrame,
    catalog: DataFrame,
    by: list[str],
    volumes: DataFrame | None = None,
    hybrid_map: DataFrame | None = None,
    done: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Every cleaned row with its match; rows already in ``done`` are carried over."""
    keys = [*by, "library_row_id"]
    pending = cleaned if done is None else resume_anti_join(cleaned, done, keys)
    isbn = F.coalesce(F.when(F.col("isbn13") != "", F.col("isbn13")), F.when(F.col("isbn") != "", F.col("isbn")))
    asked = pending.select(*keys, "title", "author", isbn.alias("isbn"))
    records = match_books(asked, catalog, keys, volumes=volumes, hybrid_map=hybrid_map, **options)
    renamed = {
        "status": "match_status", "source": "match_source", "confidence": "match_confidence",
        "title": "matched_title", "primary_author": "matched_author", "isbn": "matched_isbn",
        "isbn13": "matched_isbn13", "publication_year": "matched_publication_year",
        "primary_genre": "matched_primary_genre", "image_url": "matched_image_url", "notes": "match_notes",
    }
    flat = records.drop("description").withColumns(
        {"notes": F.to_json("notes"), "google_categories": F.coalesce(F.to_json("google_categories"), F.lit("null"))}
    ).withColumnsRenamed(renamed)
    base = pending.select(
        *keys, "goodreads_book_id", F.col("title").alias("input_title"), F.col("author").alias("input_author"),
        F.col("isbn").alias("input_isbn"), F.col("isbn13").alias("input_isbn13"), "exclusive_shelf", "bookshelves",
        "my_rating", "read_count", "date_read", "date_added", "profile_eligible", "preference_weight",
        "exclusion_from_recommendations",
    )
    matched = base.join(flat, keys)
    return matched if done is None else done.unionByName(matched)


def split_by_status(imported: DataFrame, by: list[str] | tuple = ()) -> dict[str, DataFrame]:
    """The tables cut from one import; persist it before using several."""
    status = F.col("match_status")
    excluded = [
        *by, "library_row_id", "goodreads_book_id", "input_title", "input_author", "local_book_id", "work_id",
        "hybrid_index", "exclusive_shelf",
    ]
    return {
        "matched": imported.where(status == MATCHED),
        "cold_start": imported.where(status == COLD_START),
        "unmatched": imported.where(status == UNMATCHED),
        "profile_books": imported.where(F.col("profile_eligible") & (F.col("preference_weight") != 0)),
        "exclusion_books": imported.where(F.col("exclusion_from_recommendations")).select(
            *(c for c in excluded if c in imported.columns)
        ),
    }


def distribution_counts(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, value, rows) for several columns in one pass."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))
    return rows.select(F.explode(pairs).alias("p")).groupBy("p.column", "p.value").agg(F.count("*").alias("rows"))


def import_report(imported: DataFrame) -> DataFrame:
    count = lambda condition, name: F.count_if(condition).alias(name)
    status = F.col("match_status")
    return imported.agg(
        F.count("*").alias("imported_rows"),
        count(status == MATCHED, "matched_rows"),
        count(status == COLD_START, "cold_start_rows"),
        count(status == UNMATCHED, "unmatched_rows"),
        count(F.col("profile_eligible"), "profile_eligible_rows"),
        count(F.col("exclusion_from_recommendations"), "recommendation_exclusion_rows"),
    ).withColumn("match_rate", F.coalesce(F.try_divide("matched_rows", "imported_rows"), F.lit(0.0)))
