"""The response cache as a stored table: Parquet partitioned by a hash of the key, so a change rewrites the buckets it touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.operators import enrichment
from lectern.session import cut_lineage

BUCKETS = 256


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("cache_key"), F.lit(buckets)).cast("int"))


def _replace(rows: DataFrame, path: str) -> None:
    """Writes whole buckets over the stored ones, one file each; buckets without rows here keep their files."""
    placed = rows.repartition("bucket")
    placed.write.partitionBy("bucket").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def create(cache: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Stores a cache (cache_key, fetched_at, response_json, expires_at); rows without a key aren't stored."""
    _replace(_bucketed(cache.where(F.col("cache_key").isNotNull()), buckets), path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows, without the rows that hold the place of emptied buckets."""
    return _stored(spark, path).where(F.col("cache_key").isNotNull()).drop("bucket")


def upsert(fetched: DataFrame, path: str, buckets: int = BUCKETS, ttl_days: int = enrichment.CACHE_TTL_DAYS) -> list[int]:
    """Stores responses, the latest per key; gives the buckets that were rewritten (at most ``buckets`` numbers).

    Only the touched buckets are read. They are merged into a table of their own first, so that nothing is replaced while it
    is read. Rows without a key aren't stored; nothing fetched changes nothing. ``buckets`` is the number
    that the table was made with.
    """
    spark = fetched.sparkSession
    fresh = cut_lineage(_bucketed(fetched.where(F.col("cache_key").isNotNull()), buckets))
    touched = sorted(r[0] for r in fresh.select("bucket").distinct().collect())
    if touched:
        old = _stored(spark, path).where(F.col("bucket").isin(touched) & F.col("cache_key").isNotNull()).drop("bucket")
        merged = enrichment.cache_upsert(old, fresh.drop("bucket"), ttl_days)
        _replace(cut_lineage(_bucketed(merged, buckets)), path)
    return touched


def expire(spark: SparkSession, path: str, now: Column) -> list[int]:
    """Removes expired rows from the buckets that have some; gives those buckets.

    A bucket that nothing is left of gets one row without a key, as an overwrite skips buckets without rows.
    """
    stored = _stored(spark, path)
    over = stored.where(F.col("cache_key").isNotNull() & ~F.coalesce(F.col("expires_at") > now, F.lit(False)))
    touched = sorted(r[0] for r in over.select("bucket").distinct().collect())
    if touched:
        there = stored.where(F.col("bucket").isin(touched))
        kept = enrichment.cache_expire(there.where(F.col("cache_key").isNotNull()), now)
        places = there.select("bucket").distinct().join(kept.select("bucket").distinct(), "bucket", "left_anti")
        _replace(cut_lineage(kept.unionByName(places, allowMissingColumns=True)), path)
    return touched
