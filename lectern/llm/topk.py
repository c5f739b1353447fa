"""Exact top-k search by the threshold algorithm.

Items are dealt into blocks. A block has one list for each dimension, sorted by that component. For a query the lists are read
from the end where the component's contribution is largest, all to the same depth; each item met for the first time is scored
in full. The contributions at the depth reached add up to a bound for all items not met yet; once it is below the k-th best
score, the block is done. Blocks of queries meet blocks of items; each pair gives k rows a query, and Spark merges them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.llm.common import prepare, store

#: Items and queries of a block, at most about.
ITEM_BLOCK, QUERY_BLOCK = 32_768, 2_048
#: Blocks of items that a small table is dealt into at least.
LEAST_BLOCKS = 8


def _exact(*vectors: np.ndarray) -> type:
    """The narrowest number type in which sums of products of these integers are exact."""
    most = max((int(np.abs(v).max()) for v in vectors if v.size), default=0) ** 2 * vectors[0].shape[1]
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


class SortedLists:
    """The per-dimension lists of a block of items. vectors: integers, one row an item; ids break ties."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")  # then the smaller row is the smaller id
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order])
        self.lists = np.ascontiguousarray(np.argsort(-self.vectors, axis=0, kind="stable").T.astype(np.int32))
        self.values = np.take_along_axis(self.vectors.T, self.lists, axis=1)
        self.step = max(16, len(ids) // self.lists.shape[0])

    def answer(self, queries: np.ndarray, k: int, own_ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """``top`` for each query, in numbers that hold all its sums exactly."""
        kind = _exact(queries, self.vectors)
        self.vectors, self.values = self.vectors.astype(kind), self.values.astype(kind)
        return [self.top(q, k, own) for q, own in zip(queries.astype(kind), own_ids)]

    def top(self, query: np.ndarray, k: int, own_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best items but the query's own, ties to smaller ids."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = self.ids == own_id
        left = n - int(met.sum())
        rows, scores = np.zeros(0, np.int64), np.zeros(0, query.dtype)
        depth = 0
        if not len(up) and not len(down):  # every score is zero
            rows = np.flatnonzero(~met)[:k]
            return self.ids[rows], np.zeros(len(rows), np.int64)
        while left and depth < n:
            stop = min(n, depth + self.step)
            seen = met.copy()
            seen[self.lists[up, depth:stop].ravel()] = True
            seen[self.lists[down, n - stop:n - depth].ravel()] = True
            new = np.flatnonzero(seen & ~met)
            met, left, depth = seen, left - len(new), stop
            rows, scores = np.append(rows, new), np.append(scores, self.vectors[new] @ query)
            if len(rows) > k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                keep = scores >= kth  # all that tie with the k-th
                rows, scores = rows[keep], scores[keep]
            if len(rows) >= k and stop < n:
                bound = query[up] @ self.values[up, stop] + query[down] @ self.values[down, n - stop - 1]
                if bound < scores.min():
                    break
        best = np.lexsort((rows, -scores))[:k]
        return self.ids[rows[best]], scores[best].astype(np.int64)


def scaled(vector: Column, scale: float) -> Column:
    """Each component x as floor(scale * x)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))


def usable(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def _packed(rows: DataFrame, names: list[str]) -> DataFrame:
    """(block, width, ids, numbers): the vectors of a block in one row."""

    def pack(key, table):
        ids = table.column("id").to_numpy().astype("<i8")
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<i8")
        small = flat.astype("<i2") if len(flat) and np.abs(flat).max() < 1 << 15 else flat
        return pa.table({names[0]: pa.array([key[0].as_py()], pa.int64()), "width": pa.array([key[1].as_py()], pa.int32()),
                         f"{names[0]}_ids": pa.array([ids.tobytes()], pa.binary()), f"{names[0]}_numbers": pa.array([small.tobytes()], pa.binary())})

    return rows.groupBy(names[0], "width").applyInArrow(pack, f"{names[0]} bigint, width int, {names[0]}_ids binary, {names[0]}_numbers binary")


def _unpack(ids: bytes, numbers: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    kind = "<i2" if len(numbers) == 2 * width * len(ids) else "<i8"
    return ids, np.frombuffer(numbers, kind).reshape(-1, width).astype(np.int64)


def top_k(
    items: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding",
    item_block: int = ITEM_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row whose id is divisible by ``every``, against all rows but its own.

    Components are integers floor(scale * x); |floor| below 2^28 keeps 64-bit sums exact. Vectors that are null, empty or hold
    null or non-finite components take no part, rows with a null id neither. Vectors are compared with those of the same
    length. Repeated rows count once; of rows with one id and several vectors each is a candidate, and a query takes the best.
    Of equal vectors only those with the k + 1 smallest ids can be among any k best; the others are left out, exactly.
    """
    prepare(items.sparkSession)
    good = items.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    rows = good.select("id", scaled(F.col("v"), scale).alias("vector")).distinct()
    firsts = Window.partitionBy("vector").orderBy("id")
    rows = store(rows.withColumn("place", F.row_number().over(firsts)).where((F.col("place") <= k + 1) | (F.col("id") % every == 0)), "vectors")
    candidates, queries = rows.where(F.col("place") <= k + 1), rows.where(F.col("id") % every == 0)
    n, m = rows.agg(F.count("*"), F.sum(F.when(F.col("id") % every == 0, 1).otherwise(0))).first()
    item_blocks = max(LEAST_BLOCKS, -(-n // item_block))
    query_blocks = max(1, -(-(m or 0) // query_block))

    def dealt(frame: DataFrame, name: str, blocks: int) -> DataFrame:
        return _packed(frame.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias(name), F.size("vector").alias("width"), "id", "vector"), [name, "id", "vector"])

    left = dealt(candidates, "items", item_blocks).withColumn("queries", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<bigint>")))
    right = dealt(queries, "queries", query_blocks).withColumn("items", F.explode(F.sequence(F.lit(0), F.lit(item_blocks - 1)).cast("array<bigint>")))
    pairs = left.join(right, ["items", "queries", "width"]).repartition(item_blocks * query_blocks, "items", "queries")

    def run(batches):
        for batch in batches:
            for item_ids, numbers, query_ids, wanted, width in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (
                    "items_ids", "items_numbers", "queries_ids", "queries_numbers", "width"))):
                block = SortedLists(*_unpack(item_ids, numbers, width))
                own, vectors = _unpack(query_ids, wanted, width)
                out = [(q, *found) for q, found in zip(own, block.answer(vectors, k, own))]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([q for q, _, _ in out], [len(i) for _, i, _ in out])), pa.array(np.concatenate([i for _, i, _ in out])),
                         pa.array(np.concatenate([s for _, _, s in out]))], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def check_sql(k: int = 20, every: int = 20, scale: int = 64) -> str:
    """The same by scoring all pairs."""
    return f"""
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS q FROM embeddings
        WHERE len(embedding) > 0 AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id % {every} = 0 AND a.vec_id <> b.vec_id),
    r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
    SELECT * FROM r WHERE rank <= {k}"""
