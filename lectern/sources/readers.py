"""Typed readers for JSON lines, CSV and Parquet inputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from lectern.functions.text import lenient_boolean, whole_number

# Column sets of the raw inputs.
INTERACTION_TYPES = {
    "user_id": "bigint", "book_id": "bigint", "is_read": "tinyint", "rating": "tinyint", "is_reviewed": "tinyint",
}
ID_MAP_COLUMNS = ("book_id_csv", "book_id")
INTEGER_COLUMNS = (
    "book_id", "work_id", "author_id", "best_book_id", "books_count", "ratings_count", "text_reviews_count",
    "original_publication_year", "original_publication_month", "original_publication_day", "publication_year",
    "publication_month", "publication_day", "num_pages",
)
FLOAT_COLUMNS = ("average_rating",)
BOOLEAN_COLUMNS = ("is_ebook",)
LIBRARY_REQUIRED = ("Title", "Author", "Exclusive Shelf")
LIBRARY_OPTIONAL = (
    "Book Id", "Author l-f", "Additional Authors", "ISBN", "ISBN13", "My Rating", "Publisher", "Binding",
    "Number of Pages", "Year Published", "Original Publication Year", "Date Read", "Date Added", "Bookshelves",
    "Bookshelves with positions", "My Review", "Spoiler", "Private Notes", "Read Count", "Owned Copies",
)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, partitions: int | None = None) -> DataFrame:
    """JSON lines (plain or gzip) with a fixed schema; a malformed line is fatal.

    A gzip file is one task, so ``partitions`` spreads its rows right after the read.
    """
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return rows.repartition(partitions) if partitions else rows


def _csv(spark: SparkSession, path: str) -> DataFrame:
    rows = (
        spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        .option("nullValue", None).csv(path)
    )
    return rows.toDF(*(c.strip() for c in rows.columns))


def _require(rows: DataFrame, needed, what: str) -> None:
    missing = sorted(set(needed) - set(rows.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {', '.join(missing)}")


def read_interactions(spark: SparkSession, path: str) -> DataFrame:
    """Interactions by column name with fixed integer types; a bad value is fatal."""
    rows = spark.read.option("header", True).csv(path)
    _require(rows, INTERACTION_TYPES, "interactions")
    return rows.select(*(F.col(c).cast(kind).alias(c) for c, kind in INTERACTION_TYPES.items()))


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """The id map; ids that are no numbers become null."""
    rows = spark.read.option("header", True).csv(path)
    _require(rows, ID_MAP_COLUMNS, "id map")
    number = lambda c: whole_number(c, rounded=False).alias(c)
    return rows.select(*(number(c) if c in ID_MAP_COLUMNS else F.col(c) for c in rows.columns))


def read_library_export(spark: SparkSession, path: str) -> DataFrame:
    """A library export, all text; missing optional columns are empty."""
    rows = _csv(spark, path)
    _require(rows, LIBRARY_REQUIRED, "library export")
    return library_columns(rows)


def library_columns(rows: DataFrame) -> DataFrame:
    """All 23 library columns as text, empty where absent or null, others kept."""
    named = (*LIBRARY_REQUIRED, *LIBRARY_OPTIONAL)
    text = lambda c: (
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in rows.columns else F.lit("")
    ).alias(c)
    return rows.select(*(c for c in rows.columns if c not in named), *(text(c) for c in named))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV, told by the suffix."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix == "csv":
        return spark.read.option("header", True).csv(path)
    raise ValueError(f"unsupported table format: {path}")


def normalize_types(rows: DataFrame) -> DataFrame:
    """Known boolean, integer and float columns coerced, nested ones as JSON text."""

    def column(field):
        name, kind = field.name, field.dataType
        if name in BOOLEAN_COLUMNS:
            return lenient_boolean(name)
        if name in INTEGER_COLUMNS:
            return whole_number(name, rounded=False)
        if name in FLOAT_COLUMNS:
            return F.col(name).try_cast("double")
        if kind.typeName() in ("array", "map", "struct"):
            return F.to_json(name)
        return F.col(name).cast(StringType()) if kind.typeName() == "string" else F.col(name)

    return rows.select(*(column(f).alias(f.name) for f in rows.schema))


def align_schema(rows: DataFrame, schema: StructType | Mapping[str, str]) -> DataFrame:
    """Projected to the target columns: cast leniently, null where missing."""
    target = {f.name: f.dataType for f in schema} if isinstance(schema, StructType) else dict(schema)
    column = lambda name, kind: F.col(name).try_cast(kind) if name in rows.columns else F.lit(None).cast(kind)
    return rows.select(*(column(n, k).alias(n) for n, k in target.items()))
