"""Items in balls around pivots, so that a neighbour search leaves out whole blocks.

The angle between unit vectors is a metric: an item between the angles ``low`` and ``high`` from its pivot is at least
``max(0, t - high, low - t)`` away from a query at the angle ``t``. A query first searches the balls of its nearest pivots, as many
as hold the wanted number of items; their last similarity is its floor. Of the other balls it visits those whose bound
reaches the floor. What is left out can't be among the answers, so the search is exact.

Pivots come from a bounded sample and decide the speed only; every item is placed. A ball with more items than a block holds is
dealt over parts by a hash, so copies of one vector don't meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.functions.vectors import rows_of
from lectern.session import cut_lineage

# at most so many pivots (and rows of ball statistics) reach the driver and the tasks
MOST_PIVOTS = 1024
# items sampled for each pivot
SAMPLED = 16
ROUNDS = 5
# rows handed on in one Arrow batch
BATCH = 4096


def choose_pivots(items: DataFrame, count: int) -> np.ndarray:
    """Unit vectors: farthest-first seeds among a hash sample of the items, then a few rounds of averaging."""
    sample = items.orderBy(F.xxhash64("item"), "item").limit(SAMPLED * count).select("vector").toArrow()
    points = np.unique(rows_of(sample["vector"]), axis=0)
    seeds, closest = [0], points @ points[0] if len(points) else np.zeros(0)
    while len(seeds) < min(count, len(points)):
        seeds.append(int(closest.argmin()))
        closest = np.maximum(closest, points @ points[seeds[-1]])
    pivots = points[seeds] if len(points) else points
    for _ in range(ROUNDS):
        nearest = (points @ pivots.T).argmax(axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, nearest, points)
        lengths = np.linalg.norm(sums, axis=1)
        usable = lengths > 1e-9
        pivots = np.where(usable[:, None], sums / np.where(usable, lengths, 1.0)[:, None], pivots)
    return pivots


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


def place(items: DataFrame, pivots: np.ndarray) -> DataFrame:
    """item, vector, its nearest pivot as ``ball`` and the angle to it."""
    shared = items.sparkSession.sparkContext.broadcast(pivots)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                angles = _angles(rows_of(batch.column("vector")), shared.value)
                ball = angles.argmin(axis=1)
                columns = [batch.column("item"), batch.column("vector"), pa.array(ball.astype(np.int32))]
                angle = pa.array(angles[np.arange(len(ball)), ball])
                yield pa.RecordBatch.from_arrays([*columns, angle], names=["item", "vector", "ball", "angle"])

    kind = items.schema["item"].dataType.simpleString()
    return items.select("item", "vector").mapInArrow(nearest, f"item {kind}, vector array<double>, ball int, angle double")


@dataclass(frozen=True)
class Balls:
    """Per ball: pivot, least and greatest angle of its items, their number and the parts they are dealt over."""

    pivots: np.ndarray
    low: np.ndarray
    high: np.ndarray
    count: np.ndarray
    parts: np.ndarray

    @classmethod
    def of(cls, placed: DataFrame, pivots: np.ndarray, part_rows: int) -> Balls:
        low, high, count = np.zeros(len(pivots)), np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
        # one row a pivot at most
        for r in placed.groupBy("ball").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("n")).collect():
            low[r["ball"]], high[r["ball"]], count[r["ball"]] = r["low"], r["high"], r["n"]
        return cls(pivots, low, high, count, -(-count // part_rows))

    @property
    def slack(self) -> float:
        """An allowance, in radians, for the rounding of the products that three angles come from."""
        return 6.0 * float(np.sqrt(2.0 * np.finfo(float).eps * max(self.pivots.shape[1], 1)))

    def route(self, vectors: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(balls searched first, greatest possible similarity in each ball), a row for each query."""
        angles = _angles(vectors, self.pivots)
        order = np.where(self.count > 0, angles, np.inf).argsort(axis=1, kind="stable")
        held = self.count[order]
        before = np.cumsum(held, axis=1) - held
        home = np.zeros(angles.shape, bool)
        np.put_along_axis(home, order, (before < wanted[:, None]) & (held > 0), axis=1)
        apart = np.maximum(np.maximum(angles - self.high, self.low - angles) - self.slack, 0.0)
        return home, np.cos(np.minimum(apart, np.pi))

    def open(self, home: np.ndarray, bound: np.ndarray, floor: pa.Array) -> np.ndarray:
        """The balls beside ``home`` that may hold a similarity of ``floor`` or more; a null leaves nothing out."""
        least = floor.to_numpy(zero_copy_only=False).astype(float)
        least = np.where(np.isnan(least), -np.inf, least)
        # similarities are rounded at nine decimals
        return ~home & (self.count > 0) & (bound + 1e-9 >= least[:, None])

    def visits(self, queries: DataFrame, first: bool) -> DataFrame:
        """query, wanted, vector, ball, part: the balls that each query searches first, or (by the column ``floor``; null leaves
        nothing out) the others that may still hold an answer."""
        shared = queries.sparkSession.sparkContext.broadcast(self)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            balls = shared.value
            for whole in batches:
                for start in range(0, whole.num_rows, BATCH):
                    batch = whole.slice(start, BATCH)
                    home, bound = balls.route(rows_of(batch.column("vector")), batch.column("wanted").to_numpy())
                    chosen = home if first else balls.open(home, bound, batch.column("floor"))
                    row, ball = np.nonzero(chosen)
                    times = balls.parts[ball]
                    part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    row, ball = np.repeat(row, times), np.repeat(ball, times)
                    for at in range(0, len(row), BATCH):
                        piece = slice(at, at + BATCH)
                        taken = batch.select(["query", "wanted", "vector"]).take(pa.array(row[piece]))
                        extra = [pa.array(ball[piece].astype(np.int32)), pa.array(part[piece].astype(np.int32))]
                        yield pa.RecordBatch.from_arrays([*taken.columns, *extra], names=["query", "wanted", "vector", "ball", "part"])

        kind = queries.schema["query"].dataType.simpleString()
        columns = ["query", "wanted", "vector"] if first else ["query", "wanted", "vector", "floor"]
        return queries.select(*columns).mapInArrow(
            deal, f"query {kind}, wanted bigint, vector array<double>, ball int, part int"
        )

    def stops(self, queries: DataFrame, stripes: int) -> DataFrame:
        """query, wanted, floor, vector, stripe, balls: a query once for each stripe (of the parts of all balls, numbered through)
        with the balls there that may still hold an answer, beside those that it searched first."""
        shared = queries.sparkSession.sparkContext.broadcast(self)
        ball = np.repeat(np.arange(len(self.parts)), self.parts)
        lies = np.zeros((stripes, len(self.parts)), bool)
        lies[np.arange(len(ball)) % stripes, ball] = True

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            balls = shared.value
            for whole in batches:
                for start in range(0, whole.num_rows, BATCH):
                    batch = whole.slice(start, BATCH)
                    home, bound = balls.route(rows_of(batch.column("vector")), batch.column("wanted").to_numpy())
                    open_ = balls.open(home, bound, batch.column("floor"))
                    for stripe in range(stripes):
                        visited = open_ & lies[stripe]
                        row = np.flatnonzero(visited.any(axis=1))
                        if len(row):
                            where, ball = np.nonzero(visited[row])
                            ends = np.r_[0, np.cumsum(np.bincount(where, minlength=len(row)))].astype(np.int32)
                            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ball.astype(np.int32)))
                            taken = batch.select(["query", "wanted", "floor", "vector"]).take(pa.array(row))
                            yield pa.RecordBatch.from_arrays(
                                [*taken.columns, pa.array(np.full(len(row), stripe, np.int32)), lists],
                                names=["query", "wanted", "floor", "vector", "stripe", "balls"])

        kind = queries.schema["query"].dataType.simpleString()
        return queries.select("query", "wanted", "vector", "floor").mapInArrow(
            deal, f"query {kind}, wanted bigint, floor double, vector array<double>, stripe int, balls array<int>"
        )

    def dealt(self, placed: DataFrame) -> DataFrame:
        """The items with the part of their ball, and ``unit``, the number of that part among those of all balls."""
        first = np.cumsum(self.parts) - self.parts
        parts = placed.sparkSession.createDataFrame(
            [(i, max(int(n), 1), int(f)) for i, (n, f) in enumerate(zip(self.parts, first))], "ball int, parts int, first int"
        )
        part = F.pmod(F.xxhash64("item"), F.col("parts")).cast("int")
        # MOST_PIVOTS rows of three integers
        return placed.join(F.broadcast(parts), "ball").select(
            "item", "vector", "ball", part.alias("part"), (F.col("first") + part).alias("unit")
        )


def build(items: DataFrame, rows: int, part_rows: int) -> tuple[DataFrame, Balls]:
    """(item, vector, ball, part, unit; stored) and the balls of ``rows`` unit vectors."""
    pivots = choose_pivots(items, min(MOST_PIVOTS, max(1, -(-rows // part_rows))))
    placed = cut_lineage(place(items, pivots))
    balls = Balls.of(placed, pivots, part_rows)
    return balls.dealt(placed), balls
