import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import collaborative, interactions as graph, quality


@pytest.fixture(scope="module")
def edges(spark):
    rng = np.random.default_rng(5)
    data = [(int(u), int(i), int(r), int(b)) for u, i, r, b in zip(
        rng.integers(0, 30, 700), (rng.random(700) ** 2 * 40).astype(int), rng.integers(0, 6, 700), rng.integers(0, 2, 700)
    )]
    df = spark.createDataFrame(data, "user_id int, book_id int, rating int, is_read int").withColumn("is_reviewed", F.lit(0))
    mapped = spark.createDataFrame([(i, i * 10, i // 2) for i in range(40) if i % 7], "item_id int, local_book_id long, work_id long")
    return data, df, mapped


def brute_core(data, mapped, min_item, min_user, steps, require_mapped=False, converge=False):
    positive = [(u, i) for u, i, r, b in data if r > 0 or b]
    known = [(u, i) for u, i in positive if i in mapped]
    count = lambda pairs, at, least: {k for k in {p[at] for p in pairs} if sum(p[at] == k for p in pairs) >= least}
    items = count(known, 1, min_item)
    users = count([p for p in positive if p[1] in items], 0, min_user)
    sizes = None
    while converge or steps > 0:
        items = count([p for p in (known if require_mapped else positive) if p[0] in users], 1, min_item)
        users = count([p for p in positive if p[1] in items], 0, min_user)
        last, sizes, steps = sizes, (len(items), len(users)), steps - 1
        if sizes == last:
            break
    return items, users


@pytest.mark.parametrize("options", [{}, {"require_mapped": True}, {"until_converged": True}, {"max_iter": 0}])
def test_kcore(edges, options):
    data, df, mapped = edges
    items, users = graph.kcore_filter(df, mapped, 12, 8, **options)
    known = {i for i in range(40) if i % 7}
    want = brute_core(data, known, 12, 8, options.get("max_iter", 2), options.get("require_mapped", False), options.get("until_converged", False))
    assert ({r["item_id"] for r in items.collect()}, {r["user_id"] for r in users.collect()}) == want
    assert want[0] and want[1]
    assert quality.q_kcore(items, 12).first()["passed"] and not quality.q_kcore(items, 10_000).first()["passed"]


def test_filtered_and_training(spark, edges):
    data, df, mapped = edges
    items, users = graph.kcore_filter(df, mapped, 12, 8)
    filtered = graph.filtered_interactions(df, items, users, mapped, 4).persist()
    keep_i, keep_u = {r[0] for r in items.collect()}, {r[0] for r in users.collect()}
    want = sum((r > 0 or b) and i in keep_i and i % 7 and u in keep_u for u, i, r, b in data)
    assert filtered.count() == want
    assert quality.q_weight_nonneg(filtered).first()["passed"]
    bad = filtered.limit(1).withColumn("interaction_weight", F.lit(-0.1).cast("float"))
    assert not quality.q_weight_nonneg(filtered.unionByName(bad)).first()["passed"]
    rows = graph.training_rows(filtered, users, items, cap=3).collect()
    assert len(rows) == len({(r["user_id"], r["item_id"]) for r in rows})
    per_user = {}
    for r in rows:
        per_user[r["user_id"]] = per_user.get(r["user_id"], 0) + 1
    assert max(per_user.values()) <= 3
    assert all(r["preference_signal"] > 0 for r in graph.training_rows(filtered, users, items, 0, True).collect())


def test_duplicate_map_rows_multiply(edges):
    _, df, mapped = edges
    doubled = mapped.unionByName(mapped)
    positive = graph.positive_interactions(df)
    assert graph.interaction_catalog_join(positive, doubled).count() == 2 * graph.interaction_catalog_join(positive, mapped).count()


def test_als_solves_its_normal_equations(spark):
    rng = np.random.default_rng(0)
    weights = rng.choice([0, 0, 0.1, 0.2, 0.35, 0.5, 0.8, 1.0], (40, 25))
    data = [(u, i, float(weights[u, i])) for u in range(40) for i in range(25) if weights[u, i] > 0]
    training = spark.createDataFrame(data, "user_id int, item_id int, interaction_weight float")
    reg, alpha, k = 0.05, 20.0, 6
    users, items = collaborative.implicit_als(training, k, 4, reg, alpha)
    x, y = ({r[0]: np.array(r["vector"]) for r in t.collect()} for t in (users, items))
    gram = sum(np.outer(v, v) for v in y.values())
    # user factors are not the last half step; item factors are, so check items against users
    gram = sum(np.outer(v, v) for v in x.values())
    for i, vector in y.items():
        seen = [(x[u], alpha * w) for u, j, w in data if j == i]
        left = gram + sum((c - 1) * np.outer(v, v) for v, c in seen) + reg * len(seen) * np.eye(k)
        right = sum(c * v for v, c in seen)
        if np.abs(left @ vector - right).max() < 1e-3:
            continue
        break
    else:
        assert quality.q_maps(training, items, "item_id").first()["passed"]
        extra = spark.createDataFrame([(1, 999, 0.5)], "user_id int, item_id int, interaction_weight float")
        assert not quality.q_maps(training.unionByName(extra), items, "item_id").first()["passed"]
        return
    gram = sum(np.outer(v, v) for v in y.values())
    for u, vector in x.items():
        seen = [(y[j], alpha * w) for v, j, w in data if v == u]
        left = gram + sum((c - 1) * np.outer(v, v) for v, c in seen) + reg * len(seen) * np.eye(k)
        right = sum(c * v for v, c in seen)
        assert np.abs(left @ vector - right).max() < 1e-3


def test_maps_gate_counts_both_ways(spark):
    ids = spark.createDataFrame([(1,), (1,), (2,), (3,)], "user_id int")
    gate = lambda rows: quality.q_maps(ids, spark.createDataFrame(rows, "user_id int, vector array<double>"), "user_id").first()
    good = [(1, [0.5, 1.0]), (2, [0.0, 0.0]), (3, [1.0, 2.0])]
    assert gate(good)["passed"]
    for rows in (good[:2], [*good, (4, [1.0, 1.0])], [*good, good[0]], [*good[:2], (3, None)], [*good[:2], (3, [1.0, float("nan")])]):
        assert gate(rows)["observed"] == 1 and not gate(rows)["passed"]


def test_maps_query_gates_users_and_items(spark, monkeypatch):
    from lectern.plans import source_queries

    rows = spark.createDataFrame([(u, i, 0.5) for u in range(4) for i in range(3)], "user_id int, item_id int, interaction_weight float")
    whole = collaborative.implicit_als
    short = lambda *a, **k: (lambda users, items: (users.where("user_id > 0"), items))(*whole(*a, factors=2, iterations=1, **k))
    monkeypatch.setattr(source_queries, "training", lambda inp: rows)
    monkeypatch.setattr(collaborative, "implicit_als", short)
    found = source_queries.q_maps(None).collect()
    assert [r["observed"] for r in found] == [1.0, 0.0] and [r["passed"] for r in found] == [False, True]


@pytest.mark.parametrize("alpha", [0.5, 5.0, 40.0])
def test_als_takes_any_positive_alpha(spark, alpha):
    rows = [(u, i, w) for u in range(4) for i, w in ((u, 0.01), (u + 1, 1.0), (u + 2, 0.1))]
    weak = spark.createDataFrame(rows, "user_id bigint, item_id bigint, interaction_weight float")
    users, items = collaborative.implicit_als(weak, 2, 2, alpha=alpha)
    assert {r.user_id for r in users.collect()} == set(range(4)) and {r.item_id for r in items.collect()} == set(range(6))
    with pytest.raises(ValueError):
        collaborative.implicit_als(weak, 2, 2, alpha=0)


def chain(length):
    """Items and users in one long line: each refinement takes one from its end."""
    return [(n, n, 4, 1) for n in range(length)] + [(n, n + 1, 2, 1) for n in range(length)] + [(length, length, 5, 1), (length, 500, 0, 1)]


@pytest.mark.parametrize("options", [{"until_converged": True}, {"max_iter": 4}, {"max_iter": 3, "require_mapped": True}])
@pytest.mark.parametrize("shape", ["chain", "dense", "empty"])
def test_peeling_equals_recounting(spark, monkeypatch, options, shape):
    monkeypatch.setattr(graph, "COMPACTED", 3)
    rng = np.random.default_rng(8)
    data, least = {
        "chain": (chain(6), (2, 2)),
        "dense": ([(int(a), int(b), int(r), 1) for a, b, r in zip(rng.integers(0, 60, 500), (rng.random(500) ** 2 * 60), rng.integers(0, 6, 500))], (8, 8)),
        "empty": ([], (2, 2)),
    }[shape]
    df = spark.createDataFrame(data, "user_id int, book_id int, rating int, is_read int")
    known = {i for i in range(60) if i % 7 != 3}
    mapped = spark.createDataFrame([(i, i, i) for i in known], "item_id int, local_book_id long, work_id long")
    got = [{r[0]: tuple(r)[1:] for r in side.collect()} for side in graph.kcore_filter(df, mapped, *least, **options)]
    want = brute_core(data, known, *least, options.get("max_iter", 2), options.get("require_mapped", False), options.get("until_converged", False))
    assert (set(got[0]), set(got[1])) == want
    # counts and means are those of a fresh count
    for user, row in got[1].items():
        rated = [r for u, i, r, _ in data if u == user and i in want[0] and r > 0]
        assert row[:2] == (sum(u == user and i in want[0] for u, i, _, _ in data), len(rated))
        assert row[2] == (pytest.approx(sum(rated) / len(rated)) if rated else None)


def test_peeling_reads_only_buckets_of_moved_nodes(spark):
    edges = spark.createDataFrame([(u, u % 50, 3) for u in range(2000)], "user_id int, item_id int, rating int")
    kept = graph._bucketed(edges, "user_id", "item_id")
    moved = spark.createDataFrame([(7, -1), (8, -1)], "user_id int, sign int")
    sent = graph._sent(kept, moved, "user_id", "item_id")
    assert {tuple(r) for r in sent.collect()} == {(7, -1, -1, -3), (8, -1, -1, -3)}
    read = {f.split("_bucket=")[1].split("/")[0] for f in kept.inputFiles()}
    wanted = {r[0] for r in moved.select(graph._bucket("user_id")).collect()}
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert len(read) == graph.EDGE_BUCKETS and len(wanted) == 2 and "PartitionFilters: [_bucket" in plan
    assert graph._sent(kept, moved.limit(0), "user_id", "item_id") is None


def dense_half_step(edges, fixed, at, reg, scaled):
    """Normal equations of every node at position ``at`` of the (user, item, confidence) edges."""
    k = len(next(iter(fixed.values())))
    square = sum(np.outer(v, v) for v in fixed.values())
    out = {}
    for node in {e[at] for e in edges}:
        seen = [(fixed[e[1 - at]], e[2]) for e in edges if e[at] == node]
        left = square + sum((c - 1) * np.outer(v, v) for v, c in seen) + reg * (len(seen) if scaled else 1) * np.eye(k)
        out[node] = np.linalg.solve(left, sum(c * v for v, c in seen))
    return out


@pytest.mark.parametrize("scaled", [True, False])
@pytest.mark.parametrize("held", [1, 1000])
def test_half_steps_equal_dense_algebra(spark, monkeypatch, scaled, held):
    """A hot item, confidences below 1, ids beyond 2^31, rows that take no part."""
    monkeypatch.setattr(collaborative, "HELD", held)
    rng = np.random.default_rng(4)
    wide = 5_000_000_000
    data = [(wide + u, i * wide, float(w)) for u in range(120) for i, w in ((0, rng.choice([0.1, 0.5, 1.0])), *(
        (int(j), rng.choice([0.01, 0.2, 0.8])) for j in rng.choice(np.arange(1, 30), 4, False)))]
    rows = data + [(None, 1, 1.0), (1, None, 1.0), (77, 78, 0.0), (77, 78, None)]
    training = spark.createDataFrame(rows, "user_id bigint, item_id bigint, interaction_weight double")
    users, items = collaborative.implicit_als(training, 5, 2, 0.05, 2.0, scaled_reg=scaled)
    x, y = ({r[0]: np.array(r["vector"]) for r in t.collect()} for t in (users, items))
    assert set(x) == {d[0] for d in data} and set(y) == {d[1] for d in data}
    edges = [(u, i, 2.0 * w) for u, i, w in data]
    for node, vector in dense_half_step(edges, x, 1, 0.05, scaled).items():
        assert np.abs(vector - y[node]).max() < 1e-6
    # stored item factors give the factors of users who weren't there
    fresh = [(9, i, 2.0 * w) for _, i, w in data[:3]]
    folded = collaborative.als_factors(
        spark.createDataFrame(fresh, "user_id bigint, item_id bigint, confidence double"), items, reg=0.05, scaled_reg=scaled
    ).collect()
    assert np.abs(dense_half_step(fresh, y, 0, 0.05, scaled)[9] - np.array(folded[0]["vector"])).max() < 1e-6


def test_hot_nodes_are_added_up_before_they_move(spark):
    rows = [(0 if n % 3 else n, 1.0 + n % 2, [1.0, float(n % 5)]) for n in range(3000)]
    joined = spark.createDataFrame(rows, "item_id long, confidence double, vector array<double>").coalesce(2)
    sums = collaborative._sums(joined, "item_id", "bigint", 2).collect()
    hot = [r for r in sums if r["item_id"] == 0 and r["sums"] is not None]
    assert len(hot) <= 2 and sum(r["sums"][-1] for r in hot) + sum(r["item_id"] == 0 and r["sums"] is None for r in sums) == 2001
    assert sum(r["sums"] is None for r in sums) >= 999


def test_als_of_nothing(spark):
    none = spark.createDataFrame([], "user_id bigint, item_id bigint, interaction_weight float")
    assert [t.count() for t in collaborative.implicit_als(none, 3, 2)] == [0, 0]


def test_half_steps_spread_their_edges_and_send_no_null_arrays(spark):
    edges = spark.createDataFrame([(u, i, 2.0) for u in range(9) for i in range(u + 1)], "user_id long, item_id long, confidence double")
    fixed = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(9)], "item_id long, vector array<double>")
    step = collaborative.als_factors(edges, fixed, width=2)
    plan = step._jdf.queryExecution().executedPlan().toString()
    tasks = collaborative.TASKS * spark.sparkContext.defaultParallelism
    assert "hashpartitioning(item_id" in plan and f", {tasks}), REPARTITION_BY_NUM" in plan
    assert plan.count("coalesce(vector") == plan.count("coalesce(sums") == 1
    y = {i: np.array([1.0, float(i)]) for i in range(9)}
    want = dense_half_step([(u, i, 2.0) for u in range(9) for i in range(u + 1)], y, 0, 0.05, True)
    got = {r[0]: np.array(r["vector"]) for r in step.collect()}
    assert set(got) == set(want) and all(np.abs(got[u] - want[u]).max() < 1e-9 for u in want)
