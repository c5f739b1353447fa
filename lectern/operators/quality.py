"""Data-quality gates: one row (gate, observed, expected, passed) each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _gate(name: str, measured: DataFrame, expected: Column, passed: Column) -> DataFrame:
    """``measured`` is one row with a column ``observed``."""
    return measured.select(
        F.lit(name).alias("gate"),
        F.col("observed").cast("double").alias("observed"),
        expected.cast("double").alias("expected"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def _count(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def q_rows(written: DataFrame, source: DataFrame) -> DataFrame:
    """As many rows written as read."""
    expected = _count(source)
    return _gate("q_rows", written.agg(F.count("*").alias("observed")), expected, F.col("observed") == expected)


def q_unique_book(catalog: DataFrame, key: str = "book_id") -> DataFrame:
    """No repeated id; counted per id first, so a hot id is combined early."""
    repeated = catalog.groupBy(key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("observed"))
    return _gate("q_unique_book", repeated, F.lit(0), F.col("observed") == 0)


def q_kcore(stats: DataFrame, minimum: int) -> DataFrame:
    """The smallest stored interaction count reaches the threshold."""
    return _gate(
        "q_kcore", stats.agg(F.min("interaction_count").alias("observed")), F.lit(minimum), F.col("observed") >= minimum
    )


def q_weight_nonneg(filtered: DataFrame) -> DataFrame:
    negative = filtered.agg(F.count_if(F.col("interaction_weight") < 0).alias("observed"))
    return _gate("q_weight_nonneg", negative, F.lit(0), F.col("observed") == 0)


def q_wilson_range(scored: DataFrame) -> DataFrame:
    outside = scored.agg(F.count_if(~F.col("wilson_score").between(0, 1)).alias("observed"))
    return _gate("q_wilson_range", outside, F.lit(0), F.col("observed") == 0)


def q_docs_vectors(documents: DataFrame, vectors: DataFrame) -> DataFrame:
    expected = _count(documents)
    return _gate("q_docs_vectors", vectors.agg(F.count("*").alias("observed")), expected, F.col("observed") == expected)


def q_maps(ids: DataFrame, factors: DataFrame, on: str) -> DataFrame:
    """Ids of the training rows and of the factors that do not stand on both sides, with one finite vector each."""
    whole = F.coalesce((F.size("vector") > 0) & F.forall("vector", lambda x: F.abs(x.cast("double")) < float("inf")), F.lit(False))
    held = factors.groupBy(on).agg((F.count_if(whole) == 1).alias("_whole"), F.count("*").alias("_rows"))
    sides = ids.select(on).distinct().withColumn("_asked", F.lit(True)).join(held, on, "full")
    fits = F.col("_asked") & F.col("_whole") & (F.col("_rows") == 1)
    return _gate("q_maps", sides.agg(F.count_if(~F.coalesce(fits, F.lit(False))).alias("observed")), F.lit(0), F.col("observed") == 0)


def q_self_neighbour(neighbours: DataFrame, item_id: str = "book_id") -> DataFrame:
    """Queries whose nearest item (``include_self``) is not at distance 0.

    Copies of an item share its place, so similarity is compared, not identity.
    """
    first = neighbours.where(F.col("rank") == 1)
    far = first.agg(F.count_if(F.col("similarity") < 1 - 1e-6).alias("observed"))
    return _gate("q_self_neighbour", far, F.lit(0), F.col("observed") == 0)


def q_nonempty(table: DataFrame) -> DataFrame:
    return _gate("q_nonempty", table.agg(F.count("*").alias("observed")), F.lit(1), F.col("observed") >= 1)


def catalog_checks(catalog: DataFrame) -> DataFrame:
    return catalog.agg(
        F.count("*").alias("rows"),
        F.count_distinct("book_id").alias("distinct_books"),
        F.count_if(F.col("title").isNull() | (F.trim("title") == "")).alias("missing_titles"),
        F.count_if(F.col("primary_author").isNull()).alias("missing_primary_authors"),
        F.count_if(F.col("primary_genre").isNull()).alias("missing_primary_genres"),
        F.count_if(F.col("is_canonical_edition")).alias("canonical_editions"),
        F.count_if(F.col("interaction_book_id").isNotNull()).alias("interaction_mapped_books"),
    )


def require(gate: DataFrame) -> None:
    """Fail the job when a gate does not hold."""
    row = gate.first()
    if not row["passed"]:
        raise RuntimeError(f"{row['gate']}: observed {row['observed']}, expected {row['expected']}")
