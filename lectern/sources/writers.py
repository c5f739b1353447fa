"""Sinks, output policy, row checks and reports."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

#: Bytes of a file that one task digests, and reads at a time.
RANGE_BYTES, READ_BYTES = 256 << 20, 4 << 20
CODECS = ("zstd", "snappy", "gzip", "brotli", "none")
# what to do when the output is already there
POLICIES = {"skip": "ignore", "error": "errorifexists", "overwrite": "overwrite"}


def output_policy(policy: str) -> str:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {sorted(POLICIES)}")
    return POLICIES[policy]


def write_parquet(rows: DataFrame, path: str, compression: str = "zstd", policy: str = "error") -> None:
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {CODECS}")
    rows.write.mode(output_policy(policy)).option("compression", compression).parquet(path)


def write_partitioned(
    rows: DataFrame, path: str, by: str = "user_bucket", compression: str = "zstd", policy: str = "error",
    files_per_bucket: int | None = None, rows_per_file: int = 5_000_000,
) -> None:
    """Hive layout by bucket. A bucket has as many files, and write tasks, as its counted rows need, or ``files_per_bucket``."""
    if files_per_bucket is None:
        needed = rows.groupBy(by).agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("_files"))
        rows = rows.join(needed, by)
        spread = F.pmod(F.xxhash64(*rows.columns), F.col("_files"))
    else:
        spread = F.pmod(F.xxhash64(*rows.columns), F.lit(files_per_bucket))
    placed = rows.withColumn("_file", spread).repartition(F.col(by), F.col("_file")).drop("_file", "_files")
    placed.write.mode(output_policy(policy)).option("compression", compression).partitionBy(by).parquet(path)


def write_multi_format(rows: DataFrame, folder: str, name: str, policy: str = "error") -> dict[str, str]:
    """The same rows as Parquet, CSV and JSON records; nested columns as JSON in CSV."""
    paths = {kind: f"{folder}/{name}.{kind}" for kind in ("parquet", "csv", "json")}
    nested = [f.name for f in rows.schema if f.dataType.typeName() in ("array", "map", "struct")]
    write_parquet(rows, paths["parquet"], policy=policy)
    held, mode = rows.sparkSession.read.schema(rows.schema).parquet(paths["parquet"]), output_policy(policy)
    flat = held.withColumns({c: F.to_json(c) for c in nested}) if nested else held
    flat.write.mode(mode).option("header", True).option("escape", '"').csv(paths["csv"])
    held.write.mode(mode).option("ignoreNullFields", False).json(paths["json"])
    return paths


def verify_row_count(spark: SparkSession, path: str, expected: int) -> int:
    """Rows readable at ``path``; fails unless they are the expected ones."""
    found = spark.read.parquet(path).count()
    if found != expected:
        raise RuntimeError(f"{path}: wrote {expected} rows, {found} are readable")
    return found


def write_observed(rows: DataFrame, path: str, *measures: Column, compression: str = "zstd", policy: str = "error") -> dict:
    """Writes the rows and returns how many there were, as ``rows``, with the (aliased, aggregate) measures: they are taken while
    the rows pass, so the source is read once."""
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *measures)
    write_parquet(counted, path, compression, policy)
    return seen.get


def write_verified(rows: DataFrame, path: str, compression: str = "zstd", policy: str = "error") -> int:
    """Writes the rows and fails unless as many are readable as were written; one pass over the source."""
    return verify_row_count(rows.sparkSession, path, write_observed(rows, path, compression=compression, policy=policy)["rows"])


def byte_ranges(files: DataFrame, size: int) -> DataFrame:
    """(path, length, range, start, stop) of files (path, length), each cut into ranges of ``size`` bytes; an empty file has one."""
    last = F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / size)
    cut = files.withColumn("range", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))))
    return cut.select("path", "length", "range", (F.col("range") * size).alias("start"), F.least("length", (F.col("range") + 1) * size).alias("stop"))


def _range_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for path, start, stop in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "stop"))):
            files, at = pafs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)
            digest = hashlib.sha256()
            with files.open_input_file(at) as source:
                source.seek(start)
                while start < stop:
                    data = source.read(min(READ_BYTES, stop - start))
                    if not data:
                        raise OSError(f"{path} ends before byte {stop}")
                    digest.update(data)
                    start += len(data)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("range"), pa.array(digests, pa.string())], ["path", "range", "digest"])


def file_digests(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, length, modified, sha256) of every file below a path.

    A file of up to ``range_bytes`` has the SHA-256 of its bytes. A longer one is read by ranges in many tasks, and has the SHA-256
    over the hexadecimal digests of its ranges in order; so no task holds more than a part of a file, whatever its size. Spark's file
    readers leave out files without a byte.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    facts = found.select("path", "length", F.col("modificationTime").alias("modified"))
    whole = found.where(F.col("length") <= range_bytes).select("path", F.sha2("content", 256).alias("sha256"))
    ranges = byte_ranges(facts.where(F.col("length") > range_bytes).select("path", "length"), range_bytes)
    parts = ranges.repartition(spark.sparkContext.defaultParallelism * 4, "path", "range").mapInArrow(
        _range_digests, "path string, range bigint, digest string")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("range", "digest"))), lambda r: r["digest"])
    joined = parts.groupBy("path").agg(F.sha2(F.array_join(listed, ""), 256).alias("sha256"))
    return facts.join(whole.unionByName(joined), "path")


def source_inventory(spark: SparkSession, sources: dict[str, str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per source: found or missing, files, bytes, latest modification, and the SHA-256 over its files' digests by path."""
    from pyspark.errors import AnalysisException

    listed = spark.createDataFrame([], "source string, path string, length bigint, modified timestamp, digest string")
    for name, path in sources.items():
        try:
            files = file_digests(spark, path, range_bytes)
        except AnalysisException:
            continue
        listed = listed.unionByName(files.select(F.lit(name).alias("source"), "path", "length", "modified", F.col("sha256").alias("digest")))
    stats = listed.groupBy("source").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modified").alias("modified"),
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "digest"))), lambda f: f["digest"]), ""), 256).alias("sha256"),
    )
    wanted = spark.createDataFrame(list(sources.items()), "source string, location string")
    return wanted.join(stats, "source", "left").select(
        "source", "location", F.when(F.col("files") > 0, "FOUND").otherwise("MISSING").alias("status"),
        F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"), "modified", "sha256",
    )


def content_fingerprint(rows: DataFrame) -> DataFrame:
    """Order-insensitive fingerprint of a dataset of any size: rows, and the sum of 32 bits of each row's MD5.

    A row is its columns as text in order, nulls as a zero byte, joined by the unit separator.
    """
    row = F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in rows.columns))
    bits = F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("bigint")
    return rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(bits), F.lit(0)).alias("fingerprint"))


def run_metrics(
    stage: str, measured: DataFrame, settings: dict[str, object] | None = None, seconds: float | None = None,
    distributions: DataFrame | None = None,
) -> DataFrame:
    """A one-row table of measurements as (stage, metric, value, text) rows.

    ``settings`` come as ``setting.<name>`` with their text, the stage's wall time as ``seconds``, and the rows of
    ``distribution_counts`` as ``<column>.<value>`` with their counts.
    """
    number = lambda name, value: F.struct(
        F.lit(name).alias("metric"), value.cast("double").alias("value"), F.lit(None).cast("string").alias("text"))
    pairs = [number(c, F.col(c)) for c in measured.columns]
    pairs += [number("seconds", F.lit(seconds))] if seconds is not None else []
    pairs += [
        F.struct(F.lit(f"setting.{k}").alias("metric"), F.lit(str(v)).try_cast("double").alias("value"), F.lit(str(v)).alias("text"))
        for k, v in (settings or {}).items()
    ]
    rows = measured.select(F.explode(F.array(*pairs)).alias("m")).select(F.lit(stage).alias("stage"), "m.metric", "m.value", "m.text")
    if distributions is None:
        return rows
    counted = distributions.select(
        F.lit(stage).alias("stage"), F.concat("column", F.lit("."), F.coalesce("value", F.lit(""))).alias("metric"),
        F.col("rows").cast("double").alias("value"), F.lit(None).cast("string").alias("text"))
    return rows.unionByName(counted)


def markdown_entry(columns: list[str]) -> Column:
    """One recommendation as a markdown section."""
    number = lambda c, p: F.expr(f"format_number({c}, '{p}')") if c in columns else F.lit(None).cast("string")
    filled = lambda c, default: F.coalesce(F.when(F.col(c) != "", F.col(c)), F.lit(default))
    title = filled("title", "Unknown title")
    model = F.concat_ws(
        ", ",
        F.concat(F.lit("recommendation score "), number("recommendation_score", "0.000")),
        F.concat(F.lit("hybrid similarity "), number("hybrid_similarity", "0.000")),
    )
    heading = F.coalesce(F.concat(F.lit("## "), F.col("rank").cast("string"), F.lit(". "), title), F.concat(F.lit("## "), title))
    return F.concat_ws(
        "\n",
        heading,
        F.lit(""),
        F.concat(F.lit("**Author:** "), filled("primary_author", "Unknown author")),
        F.when(F.trim("primary_genre") != "", F.concat(F.lit("**Genre:** "), F.trim("primary_genre"))),
        F.when(model != "", F.concat(F.lit("**Model:** "), model)),
        F.lit(""),
        F.coalesce(F.col("explanation"), F.lit("")),
        F.lit(""),
    )


def markdown_report(explained: DataFrame, by: str = "user_id") -> DataFrame:
    """(user, rank, markdown) sections; write them sorted for one file per user."""
    return explained.select(by, "rank", markdown_entry(explained.columns).alias("markdown"))
