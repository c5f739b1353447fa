import math
import random

import numpy as np
import pytest

from lectern.llm import topk


def brute(rows, k, every, scale):
    good = {(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = {}
    for q in {i for i, _ in good if i % every == 0}:
        best = {}
        for own, a in good:
            if own == q:
                for i, b in good:
                    if i != q and len(a) == len(b):
                        best[i] = max(best.get(i, -(1 << 62)), sum(x * y for x, y in zip(a, b)))
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            out[q, rank] = (i, s)
    return out


@pytest.mark.parametrize("item_block,query_block", [(32_768, 2_048), (40, 7)])
def test_like_all_pairs(spark, item_block, query_block):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), k=9, every=10, item_block=item_block, query_block=query_block).collect()
    want = brute([(i, np.float32(v).tolist()) for i, v in rows], 9, 10, 64)
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got} == want


def test_stops_before_the_end():
    rng = np.random.default_rng(0)
    spread = np.concatenate([rng.integers(-3, 4, (4000, 8)), rng.integers(40, 64, (40, 8))])
    block = topk.SortedLists(np.arange(len(spread)), spread)
    read = []
    lists = block.lists

    class Counted(np.ndarray):
        def __getitem__(self, at):
            found = np.asarray(lists[at])
            read.append(found.size)
            return found

    block.lists = lists.view(Counted)
    ids, scores = block.top(np.full(8, 5), 10, -1)
    order = np.lexsort((np.arange(len(spread)), -spread.sum(axis=1) * 5))[:10]
    assert ids.tolist() == order.tolist() and scores.tolist() == (spread[order].sum(axis=1) * 5).tolist()
    assert sum(read) < lists.size / 4


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [None, 1.0]), (6, []), (None, [1.0, 1.0]),
            (20, [0.0, 0.0]), (7, [-1.0, 0.5]), (7, [-1.0, 0.5]), (40, [1.0]), (8, [2.0]), (9, [0.015625, -0.001]), (60, [3.0, 4.0, 5.0])]
    rng = random.Random(1)
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, id int, vector int")
    got = topk.top_k(frame, k=3).collect()
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got} == brute(rows, 3, 20, 64)
    assert topk.top_k(frame.limit(0)).collect() == []
