"""Hot groups split over ranges give the ranks of a plain window."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds half of the rows; values repeat, some are null."""
    rng = random.Random(7)
    data = [
        ("hot" if i % 2 else rng.choice(["a", "b", None]), rng.choice([None, 1.0, 2.0, 2.5, 4.0, 4.0]), i)
        for i in range(400)
    ]
    return spark.createDataFrame(data, "k string, v double, id long").repartition(5), data


def order():
    return [F.col("v").desc_nulls_last(), F.col("id").asc()]


def brute_ranks(data, by_key):
    ranks, groups = {}, {}
    for k, v, i in data:
        groups.setdefault(k if by_key else 0, []).append((v is None, -(v or 0), i))
    for members in groups.values():
        for n, (_, _, i) in enumerate(sorted(members), 1):
            ranks[i] = n
    return ranks


@pytest.mark.parametrize("split_rows", [10, 10_000])
def test_rank_rows_by_key(skewed, split_rows):
    df, data = skewed
    ranked = ranking.rank_rows(df, ["k"], order(), "r", split_rows)
    assert {r["id"]: r["r"] for r in ranked.collect()} == brute_ranks(data, True)


@pytest.mark.parametrize("split_rows", [10, 10_000])
def test_dense_index(skewed, split_rows):
    df, data = skewed
    indexed = ranking.dense_index(df, order(), "i", split_rows)
    assert {r["id"]: r["i"] + 1 for r in indexed.collect()} == brute_ranks(data, False)


@pytest.mark.parametrize("k", [1, 3, 1500])
def test_top_k(skewed, k):
    df, data = skewed
    kept = ranking.top_k(df, ["k"], order(), k, "r").collect()
    want = {i: n for i, n in brute_ranks(data, True).items() if n <= k}
    assert {r["id"]: r["r"] for r in kept} == want


def test_salted_top_k_of_a_hot_key(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), "id")
    kept = ranking.top_k(df, ["k"], [F.col("id").desc()], 1200, "r").collect()
    assert {r["id"] for r in kept} == set(range(3800, 5000))


@pytest.mark.parametrize("split_rows", [2, 10_000])
def test_cume_dist(skewed, split_rows):
    df, data = skewed
    got = {r["id"]: r["c"] for r in ranking.cume_dist(df, "v", "c", split_rows).collect()}
    low = lambda v: -1.0 if v is None else v
    want = {i: sum(low(w) <= low(v) for _, w, _ in data) / len(data) for _, v, i in data}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("split_rows", [1, 10_000])
@pytest.mark.parametrize("q", [0.0, 0.5, 0.9, 1.0])
def test_grouped_quantile(skewed, q, split_rows):
    df, data = skewed
    got = {r["k"]: r["m"] for r in ranking.grouped_quantile(df, ["k"], "v", q, "m", split_rows).collect()}
    for key in {k for k, _, _ in data}:
        values = [v for k, v, _ in data if k == key and v is not None]
        assert got[key] == pytest.approx(np.quantile(values, q))
    whole = ranking.grouped_quantile(df, [], "v", q, "m", split_rows).first()["m"]
    assert whole == pytest.approx(np.quantile([v for _, v, _ in data if v is not None], q))


def test_top_n(skewed):
    df, data = skewed
    best = ranking.top_n(df, order(), 7, "r").collect()
    want = {i: n for i, n in brute_ranks(data, False).items() if n <= 7}
    assert {r["id"]: r["r"] for r in best} == want


def test_empty_input(spark):
    empty = spark.createDataFrame([], "k string, v double, id long")
    assert ranking.rank_rows(empty, ["k"], order(), "r").count() == 0
    assert ranking.cume_dist(empty, "v", "c").count() == 0
