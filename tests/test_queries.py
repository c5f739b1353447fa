"""A slice of the registered queries against their SQL; check.py runs all of them."""

import pytest

import __spark_entry__ as contract
from check import DATA, compare, duck

SLICE = (
    "author_bridge_join", "edition_rank", "kcore_filter", "filtered_interactions", "rank_overall", "percentiles", "tfidf",
    "knn_topk", "recommend", "explanation_text", "blocked_fuzzy_join", "clean_library", "cache_upsert", "write_partitioned",
)


@pytest.fixture(scope="module")
def con():
    return duck(f"{DATA}/sf0.001")


@pytest.mark.parametrize("name", SLICE)
def test_query(spark, con, name):
    df = contract.queries()[name](spark, f"{DATA}/sf0.001")
    assert compare(df, con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
