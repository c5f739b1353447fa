"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lectern.session import shared_dir, ship_package, tune

#: Bytes of one Arrow batch that Spark hands to Python; long texts make batches of few rows.
BATCH_BYTES = 2 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings of the operators, and the package on the executors."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    ship_package(spark)
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def place(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of the cluster."""
    return f"{shared_dir(spark).rstrip('/')}/lectern-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: a lost executor costs no recomputation, later steps read columns."""
    path = place(df.sparkSession, name)
    df.write.parquet(path)
    for tables in _open(df.sparkSession):
        tables.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _open(spark: SparkSession) -> list[list[str]]:
    return spark.sparkContext.__dict__.setdefault("_lectern_open_stages", [])


def forget(spark: SparkSession, *tables: str | DataFrame) -> None:
    """Removes working tables that nothing reads any more, given as folders or as what ``store`` returned."""
    for table in tables:
        files = [table] if isinstance(table, str) else {f.rpartition("/")[0] for f in table.inputFiles()}
        for path in files:
            found = spark._jvm.org.apache.hadoop.fs.Path(path)
            found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def stage(function):
    """For a stage of a pipeline: (spark, docs, sf_dir) with the settings of ``prepare``. What earlier stages stored on the way is
    removed first, but for tables that ``docs`` itself still reads."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        done = spark.sparkContext.__dict__.setdefault("_lectern_stage_tables", [])
        read = {f.rpartition("/")[0].rpartition("/")[2] for f in docs.inputFiles()} if done else set()
        kept = [t for t in done if t.rpartition("/")[2] in read]
        forget(spark, *(t for t in done if t not in kept))
        done[:] = kept
        _open(spark).append(done)
        try:
            return function(spark, docs, sf_dir)
        finally:
            _open(spark).pop()

    return run


def text_bytes(column: pa.Array) -> tuple[memoryview, list[int]]:
    """The UTF-8 bytes of a string column end to end, and each row's end; nulls are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    buffers = column.buffers()
    if len(column) == 0:
        return memoryview(b""), []
    ends = memoryview(buffers[1]).cast("q")[column.offset:column.offset + len(column) + 1].tolist()
    data = memoryview(buffers[2]) if buffers[2] is not None else memoryview(b"")
    return data[ends[0]:ends[-1]], [e - ends[0] for e in ends[1:]]


def text_rows(column: pa.Array) -> Iterator[bytes]:
    """Each row's UTF-8 bytes; nulls are empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; when they end, what Arrow holds back for reuse goes back to the system, as the worker lives on."""
    yield from batches
    pa.default_memory_pool().release_unused()
