import numpy as np
import pytest

from lectern.operators import balls, quality, similarity as sim


@pytest.fixture(scope="module")
def space(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((90, 8))
    vectors[40:60] = vectors[40]  # many copies: ties go to the lower id
    vectors[5] = 0
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None)], "book_id long, vector array<double>")
    queries = rng.standard_normal((25, 8))
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "user_id long, vector array<double>")
    return vectors, items, queries, asked


@pytest.mark.parametrize("blocks", [(7, 4), (1000, 1000)])
@pytest.mark.parametrize("k", [1, 12, 500])
def test_knn_is_exact(space, blocks, k):
    vectors, items, queries, asked = space
    got = sim.knn_topk(asked, items, k, item_block=blocks[0], query_block=blocks[1]).collect()
    lists = {}
    for r in got:
        lists.setdefault(r["user_id"], {})[r["rank"]] = (r["book_id"], r["similarity"])
    usable = [i for i in range(90) if i != 5]
    for u, query in enumerate(queries):
        cosine = {i: round(float(vectors[i] @ query / np.linalg.norm(vectors[i]) / np.linalg.norm(query)), 9) for i in usable}
        want = sorted(usable, key=lambda i: (-cosine[i], i))[:k]
        assert [lists[u][n][0] for n in range(1, len(want) + 1)] == want and len(lists[u]) == len(want)


def test_similar_items(space):
    _, items, _, _ = space
    nearest = sim.similar_items(items, 1, include_self=True)
    assert quality.q_self_neighbour(nearest).first()["passed"]
    others = sim.similar_items(items, 2).collect()
    assert all(r["query_id"] != r["book_id"] for r in others)
    assert {r["book_id"] for r in others if r["query_id"] == 50} == {40, 41}


def test_weighted_sum(spark):
    rows = spark.createDataFrame(
        [(1, 1.0, [1.0, 0.0]), (1, -0.5, [0.0, 1.0]), (2, 1.0, [1.0, 1.0]), (2, -1.0, [1.0, 1.0]), (3, 0.0, [1.0, 0.0]),
         (4, 1.0, [float("nan"), 1.0]), (4, 2.0, [0.0, 3.0])],
        "user_id int, w double, vector array<double>",
    )
    got = {r["user_id"]: r for r in sim.weighted_vector_sum(rows, "user_id", "w", "vector").collect()}
    assert set(got) == {1, 4}
    assert got[1]["vector"] == pytest.approx([1 / np.sqrt(1.25), -0.5 / np.sqrt(1.25)])
    assert got[4]["vector"] == pytest.approx([0, 1]) and got[4]["source_rows"] == 1


def test_hybrid_embedding(spark):
    a = spark.createDataFrame([(1, [2.0, 0.0]), (2, [1.0, 0.0])], "book_id int, vector array<double>")
    b = spark.createDataFrame([(1, [0.0, 5.0])], "book_id int, vector array<double>")
    row = sim.hybrid_embedding(a, b, 1.0, 3.0).collect()
    assert len(row) == 1 and row[0]["vector"] == pytest.approx([0.5, 0, 0, np.sqrt(0.75)])


def clustered(rng, centres, rows, width):
    middle = rng.standard_normal((centres, width)) * 4
    return middle[rng.integers(0, centres, rows)] + rng.standard_normal((rows, width)) * 0.3


def test_balls_leave_out_most_blocks_and_no_answer(spark):
    rng = np.random.default_rng(11)
    vectors = clustered(rng, 20, 1500, 12)
    vectors[:500] = vectors[0]  # a third of all rows are copies: their ball is dealt over parts
    queries = np.vstack([clustered(rng, 20, 30, 12), vectors[:2], -vectors[700:702]])
    unit = lambda m: m / np.linalg.norm(m, axis=1)[:, None]
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit(vectors))], "item long, vector array<double>")
    held, found = balls.build(items, 1500, 50)
    sizes = [r["count"] for r in held.groupBy("ball", "part").count().collect()]
    assert sum(sizes) == 1500 and max(sizes) < 120 and found.parts.max() >= 10
    cosine = np.round(unit(queries) @ unit(vectors).T, 9)
    wanted = np.full(len(queries), 5)
    home, bound = found.route(unit(queries), wanted)
    of = {r["item"]: r["ball"] for r in held.collect()}
    ball_of = np.array([of[i] for i in range(1500)])
    # no item is nearer than its ball's bound, and the first balls hold enough items
    assert (cosine <= bound[:, ball_of] + 1e-9).all()
    assert ((home * found.count).sum(axis=1) >= 5).all()
    asked = spark.createDataFrame(
        [(i, 5, v.tolist(), float(np.sort(c)[-5])) for i, (v, c) in enumerate(zip(unit(queries), cosine))],
        "query long, wanted long, vector array<double>, floor double",
    )
    first, later = ({(r["query"], r["ball"]) for r in found.visits(asked, f).collect()} for f in (True, False))
    assert not first & later and len(first) + len(later) < 0.6 * len(queries) * (found.count > 0).sum()
    # without a floor all the others are visited
    every = found.visits(asked.drop("floor").selectExpr("*", "cast(null as double) as floor"), False)
    assert every.select("query", "ball").distinct().count() == len(queries) * (found.count > 0).sum() - len(first)


@pytest.mark.parametrize("extra", [None, "more"])
def test_search_in_balls_equals_brute_force(spark, extra):
    rng = np.random.default_rng(12)
    vectors = clustered(rng, 8, 400, 6)
    vectors[:130] = vectors[0]
    queries = clustered(rng, 8, 20, 6)
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "book_id long, vector array<double>")
    asked = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(queries)], "user_id long, vector array<double>, more int")
    lists = {}
    for r in sim.knn_topk(asked, items, 4, item_block=60, query_block=50, extra=extra).collect():
        lists.setdefault(r["user_id"], []).append((r["rank"], r["book_id"]))
    unit = lambda m: m / np.linalg.norm(m, axis=1)[:, None]
    cosine = np.round(unit(queries) @ unit(vectors).T, 9)
    for u in range(20):
        best = sorted(range(400), key=lambda i: (-cosine[u, i], i))[: 4 + (u % 3 if extra else 0)]
        assert [i for _, i in sorted(lists[u])] == best


def test_block_product_holds_few_similarities():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(6)
    left, right = np.round(rng.standard_normal((1500, 4)), 1), np.round(rng.standard_normal((20_000, 4)), 1)
    queries = pa.table({"query": np.arange(1500), "wanted": np.where(np.arange(1500) % 7, 3, 30), "vector": list(left)})
    items = pa.table({"item": np.arange(20_000)[::-1], "vector": list(right)})
    tracemalloc.start()
    found = sim._score_block("query", "item")(queries, items).to_pandas()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # 512 queries at once took over 200 MB
    for q in range(0, 1500, 97):
        scores = np.round(left[q] @ right.T, sim.DECIMALS)
        order = np.lexsort((items["item"].to_numpy(), -scores))[: 3 if q % 7 else 30]
        got = found[found["query"] == q]
        assert got["item"].tolist() == items["item"].to_numpy()[order].tolist() and got["similarity"].tolist() == scores[order].tolist()


def test_query_blocks_are_sized_by_their_answers(spark, monkeypatch):
    monkeypatch.setattr(sim, "ANSWERS", 50)
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((40, 3)))]
    items = spark.createDataFrame(rows, "book_id long, vector array<double>")
    queries = items.withColumnRenamed("book_id", "user_id")
    found = sim.knn_topk(queries, items, 20)
    assert ", 16), REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()  # 40 x 20 answers by 50
    assert found.count() == 800


def test_items_pass_by_a_query_block():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(9)
    asked, k, batches, rows = np.round(rng.standard_normal((600, 8)), 2), 30, 40, 5000
    homes = [[0, 2] if q % 3 else [1] for q in range(600)]
    floors = [None if q % 2 else -1.0 for q in range(600)]
    made = lambda n: np.round(np.random.default_rng(100 + n).standard_normal((rows, 8)), 2)
    ball = lambda n: 3 * n // batches

    def form(n, is_item, queries, items, wanted, floor, balls, own, vectors):
        return pa.RecordBatch.from_arrays(
            [pa.array([7] * n), pa.array([is_item] * n), pa.array([own] * n, pa.int32()), pa.array(queries, pa.int64()), pa.array(items, pa.int64()),
             pa.array(wanted, pa.int64()), pa.array(floor, pa.float64()), pa.array(balls, pa.list_(pa.int32())),
             pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), 8).cast(pa.list_(pa.float64()))],
            names=["pair", "is_item", "ball", "query", "item", "wanted", "floor", "balls", "vector"])

    def stream():
        yield form(600, False, list(range(600)), [None] * 600, [k] * 600, floors, homes, -1, asked)
        for n in range(batches):
            none = [None] * rows
            yield form(rows, True, none, list(range(n * rows, (n + 1) * rows)), none, none, none, ball(n), made(n))

    tracemalloc.start()
    found = pa.Table.from_batches(sim._score_pairs("query", "item")(stream())).to_pandas()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # the scores of all pairs would be 960 MB; an answer a query and batch 24 MB
    assert peak < 80 << 20 and len(found) == 600 * k
    vectors, of = np.vstack([made(n) for n in range(batches)]), np.repeat([ball(n) for n in range(batches)], rows)
    for q in range(0, 600, 41):
        open_ = np.flatnonzero(np.isin(of, homes[q]))
        scores = np.round(vectors[open_] @ asked[q], sim.DECIMALS)
        want = open_[np.lexsort((open_, -scores))[:k]]
        assert found[found["query"] == q]["item"].tolist() == want.tolist()


def test_a_query_answers_once_for_a_stripe(spark):
    """Without structure every ball is visited; the answers are those of two searches, not of every ball."""
    rng = np.random.default_rng(13)
    vectors = rng.standard_normal((600, 16))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "book_id long, vector array<double>")
    queries = items.where("book_id < 40").withColumnRenamed("book_id", "user_id")
    found = sim.knn_topk(queries, items, 5, item_block=30)
    kept = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in kept and "FlatMapCoGroupsInArrow" not in kept
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    cosine = np.round(unit[:40] @ unit.T, 9)
    got = {(r["user_id"], r["rank"]): r["book_id"] for r in found.collect()}
    assert got == {(u, n + 1): b for u in range(40) for n, b in enumerate(sorted(range(600), key=lambda i: (-cosine[u, i], i))[:5])}
    assert found.select("user_id").count() == 200
