import corpus_pipeline
import __spark_entry__ as contract
from check import DATA, compare, duck
import pytest

from lectern.llm import queries
from lectern.llm.common import store


def test_stages_hand_on_documents(spark, edges):
    docs = edges.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.read.parquet(f"{DATA}/sf0.001/documents.parquet"))
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, ""), "stage")
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert encoded.count() == before and {"doc_id", "n_tokens", "ids"} <= set(encoded.columns)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0, name


def test_stages_remove_what_earlier_ones_stored(spark, sample):
    from pathlib import Path

    from lectern.session import shared_dir

    tables = lambda: {p.name for p in Path(shared_dir(spark).removeprefix("file:")).iterdir()}
    before = tables()
    first = corpus_pipeline.near_dedup(spark, sample, "")
    made = tables() - before
    unsaved = corpus_pipeline.suffix_dedup(spark, first, "")  # reads tables of the first stage
    assert made and unsaved.count() > 0
    saved = store(unsaved, "kept")
    corpus_pipeline.mix_sources(spark, saved, "")
    assert not made & tables() and saved.count() > 0


def test_registered():
    assert "pipeline" in contract.queries() and set(queries.QUERIES) <= set(contract.queries())
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in contract.queries()) == 1


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_check_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, f"{DATA}/sf0.001"), duck(f"{DATA}/sf0.001"), queries.CHECKS[name]) is None
