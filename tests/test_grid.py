"""Half steps over edges in cells: slices, hot nodes, and what is left behind."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import collaborative, grid

def edges_of(rng):
    pairs = {(u, int(i)) for u in range(300) for i in rng.choice(40, 3, False)} | {(u, 0) for u in range(300)}
    return [(10**12 + u, i, float(rng.choice([0.2, 1.0, 9.0]))) for u, i in sorted(pairs)]

@pytest.mark.parametrize("slices", [1, 3])
def test_cells_solve_like_dense_algebra(spark, monkeypatch, slices):
    monkeypatch.setattr(grid, "BLOCK_EDGES", 400)
    monkeypatch.setattr(grid, "SLICE_BYTES", 1 << 40 if slices == 1 else 1200 * 3 * 4 // slices)
    data = edges_of(np.random.default_rng(2))
    edges = spark.createDataFrame(data, "user_id bigint, item_id int, confidence double")
    cells = grid.Grid(edges, 3)
    assert cells.slices >= slices and cells.blocks >= 3 and cells.cells.count() <= cells.blocks**2
    vectors = {u: np.float32(np.sin([u % 97, u % 31, 1])).tolist() for u in sorted({d[0] for d in data})}
    fixed = spark.createDataFrame([(u, v) for u, v in vectors.items() if u % 50], "user_id bigint, vector array<double>")
    packed = cells.packed(fixed, "user_id")
    solved = cells.unpacked(collaborative.als_factors(cells, packed, "user_id", "item_id", 0.05, True), "item_id")
    got = {r[0]: np.array(r["vector"]) for r in solved.collect()}
    known = {u: np.array(v) for u, v in vectors.items() if u % 50}
    square = sum(np.outer(v, v) for v in known.values())
    assert solved.schema.simpleString() == "struct<item_id:int,vector:array<double>>" and set(got) == {d[1] for d in data}
    for item, vector in got.items():
        seen = [(known[u], c) for u, i, c in data if i == item and u in known]
        left = square + sum((c - 1) * np.outer(v, v) for v, c in seen) + 0.05 * len(seen) * np.eye(3)
        assert np.abs(vector - np.linalg.solve(left, sum(c * v for v, c in seen))).max() < 1e-5
    means = collaborative.neighbour_means(edges, fixed, "user_id", "item_id", 3)
    for r in means.collect():
        assert np.abs(np.mean([known[u] for u, i, _ in data if i == r[0] and u in known], axis=0) - r["vector"]).max() < 1e-6


def test_a_hot_node_moves_as_sums(spark):
    """An item of 300 users sends sums of each cell, not 300 vectors."""
    edges = spark.createDataFrame([(u, 0, 2.0) for u in range(300)], "user_id int, item_id int, confidence double")
    cells = grid.Grid(edges, 3)
    send = grid._sender(3, ("users", "user_at", "user_block", "user_slice"), ("items", "item_at", "item_block", "item_slice"))
    fixed = cells.packed(edges.select("user_id", F.array(*(F.lit(1.0),) * 3).alias("vector")), "user_id")
    message = send(cells.cells.toArrow(), fixed.toArrow())
    assert message.num_rows == 1 and message["vectors"][0].as_py() == b""
    assert np.frombuffer(message["sums"][0].as_py()).tolist() == [300.0] * 9 + [600.0] * 3 + [300.0]
    cells.discard()


def test_shuffle_files_go_with_their_execution(spark, tmp_path):
    from lectern.session import cut_lineage, tune

    tune(spark)
    kept = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    before = kept()
    stored = cut_lineage(spark.range(10_000).repartition(4, "id"))
    for _ in range(50):
        if kept() <= before:
            break
        time.sleep(0.1)
    assert kept() <= before and stored.count() == 10_000
