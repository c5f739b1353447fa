from collections import defaultdict

from lectern.llm import mixing
from lectern.llm.mixing import Mix


def cells(spark, rows):
    return spark.createDataFrame(rows, "source string, language string, topic string, tokens bigint")


def test_fits_given_margins(spark):
    rows = [(s, l, t, 1000 + 137 * i) for i, (s, l, t) in enumerate((s, l, t) for s in "abc" for l in ("en", "de") for t in ("x", "y"))]
    total = sum(r[3] for r in rows)
    plan = Mix(budget=0.2, rounds=40, rounds_per_store=10, targets={
        "source": {"a": 0.5, "b": 0.3, "c": 0.2}, "language": {"en": 0.6, "de": 0.4}, "topic": {"x": 0.5, "y": 0.5}})
    fitted = mixing.fit(cells(spark, rows), plan).collect()
    for dimension, targets in plan.targets.items():
        sums = defaultdict(float)
        for r in fitted:
            sums[r[dimension]] += r.weight
        for value, share in targets.items():
            assert abs(sums[value] / (0.2 * total) - share) < 1e-6


def test_never_above_what_a_cell_has(spark):
    rows = [("a", "en", "x", 10), ("b", "en", "x", 100_000), ("b", "de", "x", 5), ("c", "de", "y", 0)]
    for r in mixing.fit(cells(spark, rows), Mix()).collect():
        assert 0 <= r.weight <= r.tokens


def test_sample_follows_its_probabilities(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.weights(docs).collect()
    expected = sum(r.probability * r.tokens for r in got)
    sampled = sum(r.tokens for r in got if r.kept)
    assert len(got) == docs.count() and abs(sampled / expected - 1) < 0.1 and abs(expected / sum(r.tokens for r in got) - 0.5) < 0.05
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept}


def test_edges(edges, edge_rows):
    got = mixing.mix(edges)
    assert got.columns == [*edges.columns, "__mixed"] and got.count() == len(edge_rows)
    assert not [r for r in got.collect() if not r.text and r["__mixed"].kept]
    twins = [r["__mixed"].kept for r in got.collect() if r.doc_id == 4]
    assert twins[0] == twins[1]
    assert mixing.sample(edges.limit(0)).collect() == []
