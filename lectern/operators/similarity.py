"""Exact nearest neighbours and vector tables."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from lectern.functions.scoring import shares
from lectern.functions.vectors import concat_scaled, l2_norm, l2_normalize, rows_of
from lectern.operators import balls as around
from lectern.operators.ranking import dense_index, top_k
from lectern.session import cut_lineage

# rows per block; a block of 20 000 x 192 doubles is 30 MB
ITEM_BLOCK = 20_000
QUERY_BLOCK = 20_000
# answers of one query block; the answers of a pair of blocks lie in one task until it ends
ANSWERS = 4_000_000
# items that pass by one query block, a piece at a time; their answers are given once
STRIPE = 200_000
PIECE = 4096
# similarities that a task holds at once
CELLS = 1 << 20
# pairs of blocks share partitions beyond so many
MOST_PARTITIONS = 50_000
# similarities are compared at this many decimals, so that the order of additions
# in a block product never decides a rank
DECIMALS = 9


def _blocks(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Equally long rows as one matrix, filled chunk by chunk."""
    parts = [c for c in column.chunks if len(c)]
    width = len(parts[0][0]) if parts else 0
    out, at = np.empty((len(column), width)), 0
    for part in parts:
        out[at : at + len(part)] = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), width)
        at += len(part)
    return out


class _Search:
    """The wanted nearest items of a block of queries among items that come in pieces.

    Besides the queries it holds their answers so far, up to half as many again, and a few arrays of ``cells`` similarities. An item
    below what its query has already found, or below the query's ``floor``, is not kept.
    """

    def __init__(self, asks: pa.Table, cells: int):
        self.query, self.wanted, self.vectors = asks["query"], asks["wanted"].to_numpy(), _matrix(asks["vector"])
        self.least = np.full(len(asks), -np.inf)
        if "floor" in asks.column_names:
            floor = asks["floor"].to_numpy().astype(float)
            self.least = np.where(np.isnan(floor), -np.inf, floor)
        self.visits = np.ones((len(asks), 1), bool)
        if "balls" in asks.column_names:
            lists = asks["balls"].combine_chunks()
            row, ball = np.repeat(np.arange(len(asks)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
            self.visits = np.zeros((len(asks), int(ball.max(initial=0)) + 1), bool)
            self.visits[row, ball] = True
        self.step = max(1, cells // PIECE)
        self.kept: list[list[tuple[np.ndarray, ...]]] = [[] for _ in range(0, len(asks), self.step)]

    def look(self, ball: int, ids: np.ndarray, vectors: np.ndarray) -> None:
        """The items of one ball, for the queries that visit it."""
        if ball >= self.visits.shape[1]:
            return
        visiting = np.flatnonzero(self.visits[:, ball])
        edges = np.searchsorted(visiting, np.arange(len(self.kept) + 1) * self.step)
        for at in range(0, len(ids), PIECE):
            own, right = ids[at : at + PIECE], vectors[at : at + PIECE].T
            for block in np.flatnonzero(np.diff(edges)).tolist():
                self._meet(block, visiting[edges[block] : edges[block + 1]], own, right)

    def _meet(self, block: int, rows: np.ndarray, ids: np.ndarray, right: np.ndarray) -> None:
        scores, least, most = self.vectors[rows] @ right, self.least[rows], int(self.wanted[rows].max())
        if 0 < most < len(ids) and np.isinf(least).any():
            # everything at least as similar as the k-th: ties are settled later, by id
            least = np.maximum(least, np.partition(scores, -most, axis=1)[:, -most])
        row, column = np.nonzero(scores >= least[:, None] - 2 * 10.0**-DECIMALS)
        best, row = np.round(scores[row, column], DECIMALS), rows[row]
        enough = best >= self.least[row]
        self.kept[block].append((row[enough].astype(np.int32), ids[column[enough]], best[enough]))
        share = self.wanted[block * self.step : (block + 1) * self.step].sum()
        if sum(len(k[0]) for k in self.kept[block]) > 1.5 * share:
            self._cut(block)

    def _cut(self, block: int) -> None:
        row, ids, best = (np.concatenate(c) for c in zip(*self.kept[block]))
        order = np.lexsort((ids, -best, row))
        row, ids, best = row[order], ids[order], best[order]
        first = np.r_[0, np.flatnonzero(np.diff(row)) + 1][: len(row)]
        place = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
        keep, last = place < self.wanted[row], place == self.wanted[row] - 1
        self.least[row[last]] = best[last]
        self.kept[block] = [(row[keep], ids[keep], best[keep])]

    def answers(self, by: str, item_id: str, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        for block in range(len(self.kept)):
            if self.kept[block]:
                self._cut(block)
                [(row, ids, best)] = self.kept[block]
                asked = pa.chunked_array([self.query.take(pa.array(row))]) if isinstance(self.query, pa.Array) else self.query.take(pa.array(row))
                self.kept[block] = []
                columns = {by: asked, item_id: pa.array(ids).cast(kind), "similarity": pa.array(best), "_wanted": pa.array(self.wanted[row])}
                yield from pa.table(columns).combine_chunks().to_batches()


def _score_block(by: str, item_id: str, cells: int = CELLS):
    """The wanted number of items of one item block for every query of one query block."""

    def score(queries: pa.Table, items: pa.Table) -> pa.Table:
        search = _Search(queries, cells)
        search.look(0, items["item"].to_numpy(), _matrix(items["vector"]))
        kind = items["item"].type
        empty = pa.schema([(by, queries["query"].type), (item_id, kind), ("similarity", pa.float64()), ("_wanted", queries["wanted"].type)])
        return pa.Table.from_batches(search.answers(by, item_id, kind), empty).drop_columns(["_wanted"])

    return score


def _score_pairs(by: str, item_id: str, cells: int = CELLS):
    """Rows sorted by ``pair``, queries before items and items by ball: each pair's answers, while its items pass by."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, asks, search, kind = None, [], None, None
        for batch in batches:
            marks = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "is_item", "ball")]
            cuts = np.flatnonzero(np.logical_or.reduce([np.diff(m.astype(np.int64)) != 0 for m in marks])) + 1
            for start, stop in zip(np.r_[0, cuts].tolist(), np.r_[cuts, batch.num_rows].tolist()):
                if start == stop:
                    continue
                if marks[0][start] != pair:
                    if search is not None:
                        yield from search.answers(by, item_id, kind)
                    pair, asks, search, kind = marks[0][start], [], None, batch.schema.field("item").type
                rows = batch.slice(start, stop - start)
                if not marks[1][start]:
                    asks.append(rows.select(["query", "wanted", "floor", "balls", "vector"]))
                    continue
                if search is None and asks:
                    search, asks = _Search(pa.Table.from_batches(asks), cells), []
                if search is not None:
                    search.look(int(marks[2][start]), rows.column("item").to_numpy(zero_copy_only=False), rows_of(rows.column("vector")))
        if search is not None:
            yield from search.answers(by, item_id, kind)

    return score


def knn_topk(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    by: str = "user_id",
    item_id: str = "book_id",
    vector: str = "vector",
    item_block: int = ITEM_BLOCK,
    query_block: int = QUERY_BLOCK,
    extra: str | None = None,
    stripe: int = STRIPE,
) -> DataFrame:
    """The exact ``k`` most similar items (cosine) per query, ranked, ties by item id.

    ``extra`` names an integer column of the queries: so many items more than ``k`` are found for that query.

    Query blocks are of bounded size; items pass by them batch by batch, so a task holds
    k rows per query and never its items. Items of more than ``item_block`` rows lie in
    balls around pivots (``balls``), and a query leaves out those that can't hold an
    answer: it searches the balls around it first, then the others by what it has found,
    in stripes of about ``stripe`` items. Zero, infinite and missing vectors take no part.
    """
    unit = lambda df, key, name, *more: df.select(F.col(key).alias(name), l2_normalize(vector).alias("vector"), *more).where(
        F.col("vector").isNotNull()
    )
    wanted = (F.lit(k) + F.coalesce(F.col(extra), F.lit(0)) if extra else F.lit(k)).cast("bigint")
    left, right = unit(queries, by, "query", wanted.alias("wanted")), unit(items, item_id, "item")
    total = items.count()
    item_blocks = _blocks(total, item_block)
    # small inputs still use every core
    cores = queries.sparkSession.sparkContext.defaultParallelism
    sizes = queries.agg(F.count("*"), F.max(wanted), F.sum(F.least(wanted, F.lit(min(total, item_block))))).first()
    asked, most = sizes[0], sizes[1] or k
    query_blocks = max(_blocks(asked, query_block), _blocks(sizes[2] or 0, ANSWERS), min(_blocks(asked, 64), _blocks(cores, item_blocks)))
    kinds = (queries.schema[by].dataType.simpleString(), items.schema[item_id].dataType.simpleString())
    score = _score_pairs(by, item_id), f"{by} {kinds[0]}, {item_id} {kinds[1]}, similarity double, _wanted bigint"
    own = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))

    def products(asking: DataFrame, held: DataFrame, pairs: int) -> DataFrame:
        """Matrix products of the queries and items of equal ``pair``, a partition for each pair however the session is set."""
        # a query and an item have one row form, so that a task reads a pair's queries first and then its items, batch by batch
        null = lambda c, kind: F.lit(None).cast(kind).alias(c)
        asks = asking.select("pair", F.lit(False).alias("is_item"), F.lit(-1).alias("ball"), "query", null("item", kinds[1]), "wanted", "floor", "balls", "vector")
        gives = held.select("pair", F.lit(True).alias("is_item"), "ball", null("query", kinds[0]), "item", null("wanted", "bigint"),
                            null("floor", "double"), null("balls", "array<int>"), "vector")
        met = asks.unionByName(gives).repartition(min(pairs, MOST_PARTITIONS), "pair").sortWithinPartitions("pair", "is_item", "ball")
        return met.mapInArrow(*score)

    order = [F.col("similarity").desc(), F.col(item_id).asc()]
    unbounded = F.lit(None).cast("double").alias("floor")
    if item_blocks == 1:
        asking = left.select("query", "wanted", unbounded, "vector", F.array(F.lit(0)).alias("balls"), own("query", query_blocks).alias("pair"))
        found = products(asking, right.select("item", F.lit(0).alias("ball"), "vector", blocks.alias("pair")), query_blocks)
    else:
        held, balls = around.build(right, total, item_block)
        # first the balls around each query, in blocks of the queries that come to a ball
        homes = balls.visits(left, True)
        sums = homes.groupBy("ball").agg(F.count("*").alias("n"), F.sum(F.least("wanted", F.lit(item_block))).alias("answers")).collect()
        spare = _blocks(cores, item_blocks)
        runs = {
            r["ball"]: -(-max(_blocks(r["n"], query_block), _blocks(r["answers"] or 0, ANSWERS), min(_blocks(r["n"], 64), spare)) // int(balls.parts[r["ball"]]))
            for r in sums
        }
        first, most_runs = np.cumsum(balls.parts) - balls.parts, max(runs.values(), default=1)
        # a row for each ball
        rows = [(int(b), int(n), int(first[b])) for b, n in runs.items()]
        blocked = F.broadcast(left.sparkSession.createDataFrame(rows, "ball int, runs int, first int"))
        pair = lambda unit, run: (unit * most_runs + run).cast("bigint").alias("pair")
        run = F.pmod(F.xxhash64("query", F.lit(1)), F.col("runs"))
        asking = homes.join(blocked, "ball").select(
            "query", "wanted", unbounded, "vector", F.array("ball").alias("balls"), pair(F.col("first") + F.col("part"), run))
        every = F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run")
        giving = held.join(blocked, "ball").select("item", "ball", "unit", "vector", every).select("item", "ball", "vector", pair(F.col("unit"), F.col("run")))
        pairs = sum(int(balls.parts[b]) * n for b, n in runs.items())
        near = cut_lineage(top_k(products(asking, giving, max(1, pairs)), [by], order, most, "_rank"))
        # one row a query at most
        floors = near.where(F.col("_rank") == F.col("_wanted")).select(F.col(by).alias("_query"), F.col("_rank").cast("bigint").alias("_rank"), F.col("similarity").alias("floor"))
        asking = left.join(floors, (F.col("query") == F.col("_query")) & (F.col("wanted") == F.col("_rank")), "left")
        # then the others, one answer list of a query for all balls of a stripe
        stripes = min(int(balls.parts.sum()), _blocks(total, stripe))
        place = lambda s, q: (s * query_blocks + q).cast("int").alias("pair")
        asking = balls.stops(asking, stripes).withColumn("pair", place(F.col("stripe"), own("query", query_blocks)))
        giving = held.select("item", "ball", "vector", "unit", blocks.alias("qb")).withColumn("pair", place(F.col("unit") % stripes, F.col("qb")))
        found = near.drop("_rank").unionByName(products(asking, giving, stripes * query_blocks))
    best = top_k(found.drop("_wanted"), [by], order, most, "rank")
    if extra is None:
        return best
    limits = queries.select(F.col(by), wanted.alias("_wanted"))
    return best.join(limits, by).where(F.col("rank") <= F.col("_wanted")).drop("_wanted")


def similar_items(
    items: DataFrame, k: int, item_id: str = "book_id", vector: str = "vector", include_self: bool = False
) -> DataFrame:
    """The ``k`` nearest items of every item."""
    queries = items.select(F.col(item_id).alias("query_id"), vector)
    wanted = k if include_self else k + 1
    found = knn_topk(queries, items, wanted, "query_id", item_id, vector)
    if include_self:
        return found
    others = found.where(F.col("query_id") != F.col(item_id)).drop("rank")
    return top_k(others, ["query_id"], [F.col("similarity").desc(), F.col(item_id).asc()], k, "rank")


def vector_table(vectors: DataFrame, key: str, vector: str = "vector") -> DataFrame:
    """Long form: one row per key and dimension."""
    return vectors.select(key, F.posexplode(vector).alias("dimension", "value")).withColumn(
        "value", F.col("value").cast("float")
    )


def vector_norms(vectors: DataFrame, key: str, vector: str = "vector") -> DataFrame:
    return vectors.select(key, l2_norm(vector).alias("norm"))


def weighted_vector_sum(rows: DataFrame, by: str, weight: str, vector: str, out: str = "vector") -> DataFrame:
    """Per key: sum(w * v) / sum(|w|), brought to unit length.

    The vector sums combine before the shuffle, so a key with very many rows is never
    gathered. Non-finite vectors stay out; keys whose absolute weights add up to 0 or
    whose mean is zero give no row.
    """
    usable = rows.where(F.forall(F.col(vector), lambda x: F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform(F.col(vector), lambda x: x.cast("double") * F.col(weight))
    sums = (
        usable.select(by, F.abs(weight).alias("_weight"), array_to_vector(scaled).alias("_scaled"))
        .groupBy(by)
        .agg(
            F.sum("_weight").alias("_total"),
            F.count("*").alias("source_rows"),
            Summarizer.sum(F.col("_scaled")).alias("_sum"),
        )
    )
    # dividing by the total does not change the direction
    units = sums.where(F.col("_total") > 0).select(by, l2_normalize(vector_to_array("_sum")).alias(out), "source_rows")
    return units.where(F.col(out).isNotNull())


def embedding_gather(df: DataFrame, vectors: DataFrame, on: str, vector: str = "vector", out: str = "vector") -> DataFrame:
    """Vectors fetched by id; ids without a vector drop out."""
    return df.join(vectors.select(on, F.col(vector).alias(out)), on)


def hybrid_align_join(content: DataFrame, items: DataFrame, scored: DataFrame) -> DataFrame:
    """Content items that have factors, with their popularity scores where known."""
    factors = items.select(F.col("local_book_id").alias("book_id"), "average_user_rating", "rating_count")
    popularity = scored.select("book_id", "wilson_score", "bayesian_score", "novelty_score")
    return (
        content.join(factors, "book_id")
        .withColumnRenamed("rating_count", "collaborative_rating_count")
        .join(popularity, "book_id", "left")
    )


def hybrid_embedding(
    content: DataFrame,
    collaborative: DataFrame,
    content_weight: float = 0.45,
    collaborative_weight: float = 0.40,
    on: str = "book_id",
) -> DataFrame:
    """[sqrt(share) * content ; sqrt(share) * collaborative], unit length."""
    share = shares({"content": content_weight, "collaborative": collaborative_weight})
    joined = content.select(on, F.col("vector").alias("_c")).join(
        collaborative.select(on, F.col("vector").alias("_k")), on
    )
    vector = concat_scaled("_c", math.sqrt(share["content"]), "_k", math.sqrt(share["collaborative"]))
    return joined.select(on, vector.alias("vector"))


def hybrid_index(aligned: DataFrame, key: str = "book_id") -> DataFrame:
    return dense_index(aligned, [F.col(key).asc()], "hybrid_index")
