"""Removal of repeated lines with levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z lower-cased; keys are known by 128 bits of hash. The corpus comes
in batches by falling id. A run is a table of the keys that its batch saw first, with the largest id of the batch that holds
them, bucketed and sorted by hash. A new batch

1. has its keys counted, in a table bucketed and sorted the same way,
2. merge-anti-joins the runs, one after the other, which moves neither side: what is left is new and becomes its own run,
3. files the rest, the keys that a run has already, with their numbers of documents only.

``FANOUT`` runs of one level are compacted into one of the next, so a batch meets few runs however many came before. As ids
fall, the run that holds a key holds its keeper. Everything is built of DataFrame functions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.llm.common import forget, place, prepare, store

#: Batches of one corpus, and runs of a level that are compacted into one.
BATCHES, FANOUT = 8, 3
#: Bytes of text for each bucket of the runs (hashes take about a tenth); there are as many as shuffle partitions at least.
BUCKET = 2 << 30
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def keyed_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """(batch columns..., doc, row, pos, h1, h2): the lines that can repeat, of a table (doc, row, text, ...)."""
    keys = F.transform(F.split("text", "\n"), line_key)
    hashes = F.transform(keys, lambda k: F.when(
        F.char_length(k) >= least_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))))
    kept = [c for c in docs.columns if c != "text"]
    found = docs.select(*kept, F.posexplode(hashes).alias("pos", "hash")).where("hash is not null")
    return found.select(*kept, "pos", "hash.h1", "hash.h2")


def bucketed(rows: DataFrame, buckets: int, *parts: str) -> tuple[str, str]:
    """(name, folder) of a new table of the rows, bucketed and sorted by hash; with ``parts``, one file for each of their values
    in a bucket."""
    name, path = f"lectern_run_{uuid.uuid4().hex}", place(rows.sparkSession, "run")
    out = rows.repartition(buckets, *_HASH).write.bucketBy(buckets, *_HASH).sortBy(*_HASH).format("parquet").option("path", path)
    (out.partitionBy(*parts) if parts else out).saveAsTable(name)
    return name, path


def key_counts(lines: DataFrame, *by: str) -> DataFrame:
    """(by..., h1, h2, docs, last) of (by..., doc, h1, h2): the different docs with a key, and the largest. A hot key is counted
    where it lies."""
    held = lines.select(*by, *_HASH, "doc").distinct()
    return held.groupBy(*by, *_HASH).agg(F.count("*").alias("docs"), F.max("doc").alias("last"))


class LineRuns:
    """The runs seen so far. ``add`` batches in the order in which they shall keep their lines, then ask for ``totals``."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[tuple[str, str]]] = [[]]
        self.again: list[DataFrame] = []

    def _drop(self, table: tuple[str, str]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table[0]}")
        forget(self.spark, table[1])

    def runs(self) -> list[tuple[str, str]]:
        return [t for level in reversed(self.levels) for t in level]

    def add(self, counted: DataFrame) -> None:
        """A batch of (h1, h2, docs, last), each key once. From a table bucketed like the runs nothing is moved."""
        fresh = counted
        for name, _ in self.runs():
            fresh = fresh.join(self.spark.table(name).select(*_HASH).hint("merge"), _HASH, "left_anti")
        run = bucketed(fresh, self.buckets)
        seen = counted.join(self.spark.table(run[0]).select(*_HASH).hint("merge"), _HASH, "left_anti")
        self.again.append(store(seen.select(*_HASH, "docs"), "again"))
        self.levels[0].append(run)
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                self._compact(level)

    def _compact(self, level: int) -> None:
        """The runs of a level become one run of the next. No key is in two runs."""
        old = self.levels[level]
        rows = self.spark.table(old[0][0])
        for name, _ in old[1:]:
            rows = rows.unionByName(self.spark.table(name))
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level + 1].append(bucketed(rows, self.buckets))
        self.levels[level] = []
        for table in old:
            self._drop(table)

    def totals(self, least_docs: int) -> DataFrame:
        """(h1, h2, last) of the keys in at least so many documents; last is the largest doc of the first batch that had it."""
        again = None
        for part in self.again:
            again = part if again is None else again.unionByName(part)
        again = again.groupBy(*_HASH).agg(F.sum("docs").alias("more"))
        found = None
        for name, _ in self.runs():
            rows = self.spark.table(name).join(again, _HASH, "left").where(F.col("docs") + F.coalesce("more", F.lit(0)) >= least_docs)
            rows = rows.select(*_HASH, "last")
            found = rows if found is None else found.unionByName(rows)
        kept = store(found, "repeated-lines")
        for table in self.runs():
            self._drop(table)
        self.levels = [[]]
        return kept


def drop_lines(lines: Column, gone: Column) -> Column:
    """The lines whose places (from 0, in order) aren't in ``gone``; linear in both."""
    n = F.size(gone)
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.element_at(gone, i))
    after = lambda i: F.when(i == n, F.size(lines)).otherwise(F.element_at(gone, i + 1))
    pieces = F.transform(F.sequence(F.lit(0), n), lambda i: F.slice(lines, before(i) + 2, after(i) - before(i) - 1))
    return F.when(n == 0, lines).otherwise(F.flatten(pieces))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 40, least_docs: int = 5,
    batches: int = BATCHES, fanout: int = FANOUT,
) -> DataFrame:
    """(id, n_lines, n_dropped, kept): each text without the lines whose key (``least_chars`` code points or more) is in at least
    ``least_docs`` documents, but for the document with the largest id among them, which keeps all its lines.

    A null or empty text is one empty line, kept is then empty. Rows with the same id are one document: they count once and lose
    or keep a line together, and each comes out. Rows with a null id are one document too, before all others. A key twice in one
    document counts once. An empty table gives no rows. Ids are integers; only the two columns are read.
    """
    spark = prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    doc = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63)))
    slim = docs.select(F.col(id_col).alias("id"), doc.alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    slim = slim.withColumn("row", F.xxhash64("text"))
    steps = F.array(*(F.lit(i / batches) for i in range(1, batches)))
    size, cuts = slim.agg(F.sum(F.octet_length("text")), F.percentile_approx("doc", steps, F.lit(1000))).first()
    cuts = sorted(set(cuts or []))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size or 0) // BUCKET + 1)
    # how many cuts are at or above the id: the first batch has the largest ids
    batch = sum((F.when(F.col("doc") <= c, 1).otherwise(0) for c in cuts), F.lit(0))
    lines = store(keyed_lines(slim.select("doc", "row", "text").withColumn("batch", batch), least_chars), "lines")
    name, path = bucketed(key_counts(lines, "batch"), buckets, "batch")
    runs = LineRuns(spark, buckets, fanout)
    for i in range(len(cuts) + 1):
        runs.add(spark.table(name).where(F.col("batch") == i).drop("batch"))
    spark.sql(f"DROP TABLE {name}")
    forget(spark, path)
    repeated = runs.totals(least_docs)
    gone = lines.join(repeated, _HASH).where("doc <> last").groupBy("doc", "row").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    split = F.split("text", "\n")
    none = F.array().cast("array<int>")
    found = slim.join(gone, ["doc", "row"], "left").withColumn("gone", F.coalesce("gone", none)).withColumn("lines", split)
    return found.select(
        F.col("id").cast(kind).alias(id_col), F.size("lines").cast("bigint").alias("n_lines"), F.size("gone").cast("bigint").alias("n_dropped"),
        F.array_join(drop_lines(F.col("lines"), F.col("gone")), "\n").alias("kept"))


def check_sql() -> str:
    """The query's rows in DuckDB."""
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH cut AS (
  SELECT doc_id, row_no, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM (SELECT *, row_number() OVER () AS row_no FROM documents)
), line AS (
  SELECT doc_id, row_no, unnest(lines) AS line, unnest(range(len(lines))) AS pos, len(lines) AS n_lines FROM cut
), keyed AS (
  SELECT *, translate(trim(line, {space}), '{UPPER}', '{LOWER}') AS key FROM line
), repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.last AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, CAST(any_value(n_lines) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row_no"""
