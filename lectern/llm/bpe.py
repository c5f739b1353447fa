"""Byte-level BPE: encoding in overlapping chunks, decoding by concatenating raw bytes.

A long text is cut into chunks that overlap. Each chunk is pre-tokenised on its own, in parallel. A chunk starts anywhere, so
its first tokens may be wrong; from the first boundary that it shares with the chunk before it, both agree. The text is cut
again at those places, and the pieces are encoded in parallel. Texts of one chunk need no stitching.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from lectern.llm.common import prepare, store

#: Code points of a chunk and of its overlap with the next one.
CHUNK, OVERLAP = 32_768, 1_024


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a file of ranks; one per worker and file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def boundaries(text: str, pattern: str, start: int, stop: int) -> list[int]:
    """Ends of pre-tokens in [start, stop) where a piece may end: after a character that is no white space.

    (At the end of a text the pattern takes a run of white space whole, in its middle not.) The last match is left out if it
    reaches the end of the text, as it might go on.
    """
    found = []
    for match in regex.finditer(pattern, text):
        end = match.end()
        if end >= stop or end >= len(text):
            break
        if end >= start and not text[end - 1].isspace():
            found.append(end)
    return found


def _ids(piece: str, encoding: tiktoken.Encoding) -> bytes:
    return encoding.encode_to_numpy(piece, disallowed_special=()).astype("<u4").tobytes()


def _digest(ids: bytes, encoding: tiktoken.Encoding) -> tuple[int, str, str]:
    numbers = np.frombuffer(ids, "<u4")
    decoded = hashlib.sha256()
    for at in range(0, len(numbers), 1 << 16):
        decoded.update(encoding.decode_bytes(numbers[at:at + (1 << 16)].tolist()))
    return len(numbers), hashlib.sha256(ids).hexdigest(), decoded.hexdigest()


def _strings(column: pa.Array) -> list[str]:
    return [v.as_py().decode("utf-8", "replace") for v in column.cast(pa.large_binary()).fill_null(b"")]


def chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, part, text): each text of (row, text) in overlapping chunks, spread over the cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), _strings(batch.column(1))):
                for part, at in enumerate(range(0, max(1, len(text)), chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), pa.array([part], pa.int64()), pa.array([text[at:at + chunk + overlap]], pa.string())],
                        ["row", "part", "text"])

    return long.mapInArrow(run, "row bigint, part bigint, text string").repartition("row", "part")


def pieces(parts: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(row, part, head, tail, cut): the part's own code points up to and from the place where it agrees with the part before.

    cut is null where two chunks share no boundary within their overlap; the text then runs on.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _strings(batch.column(2))
            first = [boundaries(t, pattern, 0, overlap) for t in texts]
            last = [[b - chunk for b in boundaries(t, pattern, chunk, chunk + overlap)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first, pa.list_(pa.int32())), pa.array(last, pa.list_(pa.int32()))],
                ["row", "part", "text", "first", "last"])

    scanned = parts.mapInArrow(scan, "row bigint, part bigint, text string, first array<int>, last array<int>")
    order = Window.partitionBy("row").orderBy("part")
    places = scanned.select("row", "part", "first", "last").withColumn("cut", F.array_min(F.array_intersect("first", F.lag("last").over(order))))
    places = store(places.select("row", "part", "cut"), "cuts")
    # a piece of a chunk up to its cut belongs to the piece that began before it
    placed = parts.join(places, ["row", "part"]).withColumn("own", F.substring("text", 1, chunk))
    return placed.select(
        "row", "part", "cut",
        F.when(F.col("cut").isNull(), F.col("own")).otherwise(F.expr("substring(own, 1, cut)")).alias("head"),
        F.when(F.col("cut").isNotNull(), F.expr("substring(own, cut + 1)")).alias("tail"))


def encode_long(long: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(row, ids): the ids of each text of (row, text) as little-endian 32-bit integers."""
    stitched = pieces(chunks(long, chunk, overlap), pattern, chunk, overlap)
    order = Window.partitionBy("row").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = stitched.withColumn("piece", F.sum(F.when(F.col("cut").isNotNull(), 1).otherwise(0)).over(order))
    heads = begun.select("row", (F.col("piece") - F.when(F.col("cut").isNotNull(), 1).otherwise(0)).alias("piece"), "part", F.lit(1).alias("side"), F.col("head").alias("text"))
    tails = begun.where("cut is not null").select("row", "piece", "part", F.lit(2).alias("side"), F.col("tail").alias("text"))
    whole = heads.unionByName(tails).groupBy("row", "piece").agg(F.sort_array(F.collect_list(F.struct("part", "side", "text"))).alias("texts"))
    whole = whole.select("row", "piece", F.concat_ws("", F.col("texts.text")).alias("text")).repartition("row", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load(path, pattern)
        for batch in batches:
            made = [_ids(t, encoding) for t in _strings(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], ["row", "piece", "ids"])

    encoded = whole.mapInArrow(run, "row bigint, piece bigint, ids binary")
    return encoded.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("pieces")).select(
        "row", F.concat(F.aggregate("pieces.ids", F.lit(b""), lambda a, x: F.concat(a, x))).alias("ids"))


def _encoded(texts: DataFrame, path: str, pattern: str, give_ids: bool) -> DataFrame:
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load(path, pattern)
        for batch in batches:
            binary = pa.types.is_binary(batch.schema.field(1).type) or pa.types.is_large_binary(batch.schema.field(1).type)
            ids = batch.column(1).to_pylist() if binary else [_ids(t, encoding) for t in _strings(batch.column(1))]
            made = [_digest(i, encoding) for i in ids]
            more = [pa.array(ids, pa.binary())] if give_ids else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *more, pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.string()),
                 pa.array([m[2] for m in made], pa.string())], ["id", *(["ids"] if give_ids else []), *names])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, " + ("ids binary, " if give_ids else "") + "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP,
    give_ids: bool = False,
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, and with ``give_ids`` the ids as little-endian 32-bit integers.

    A null text is empty. A null id stays null, and repeated rows come out as often as they came in, long texts too. Texts
    without a shared boundary in an overlap (one endless run of letters) are joined again and encoded as one piece. Only
    the two columns are read.
    """
    prepare(docs.sparkSession)
    pairs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    is_long = F.octet_length("text") > chunk  # of more code points than a chunk, or of fewer: either way is right
    short = _encoded(pairs.where(~is_long), path, pattern, give_ids)
    long = store(pairs.where(is_long).withColumn("row", F.monotonically_increasing_id()), "long")
    ids = encode_long(long.select("row", "text"), path, pattern, chunk, overlap)
    joined = long.select("row", "id").join(ids, "row").select("id", "ids")
    return short.unionByName(_encoded(joined, path, pattern, give_ids)).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes): the raw bytes of the ids' tokens end to end. Null ids decode to nothing."""
    prepare(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load(path, pattern)
        for batch in batches:
            made = [encoding.decode_bytes(np.frombuffer(v or b"", "<u4").tolist()) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], [id_col, "bytes"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col), F.col(ids_col)).mapInArrow(run, f"{id_col} {kind}, bytes binary")
