import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import content, svd

TEXTS = {1: "red cat red dog", 2: "cat dog bird", 3: "red red red fish cat", 4: "bird fish"}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "book_id long, content_text string")


def by_hand(min_df, max_df, features):
    grams = {}
    for i, t in TEXTS.items():
        words = t.split()
        grams[i] = Counter(words + [" ".join(p) for p in zip(words, words[1:])])
    df, cf = Counter(), Counter()
    for counts in grams.values():
        df.update(counts.keys())
        cf.update(counts)
    n = len(TEXTS)
    kept = sorted((t for t in df if min_df <= df[t] <= max_df * n), key=lambda t: (-cf[t], t))[:features]
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in kept}
    out = {}
    for i, counts in grams.items():
        raw = {t: (1 + math.log(c)) * idf[t] for t, c in counts.items() if t in idf}
        length = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(i, t): v / length for t, v in raw.items()})
    return out


@pytest.mark.parametrize("limits", [(1, 1.0, 100), (2, 0.7, 100), (1, 1.0, 3)])
def test_tfidf_by_hand(docs, limits):
    min_df, max_df, features = limits
    model = content.tfidf_fit(docs, features, min_df, max_df, sample="all")
    got = {(r["book_id"], r["term"]): r["weight"] for r in content.tfidf_transform(model, docs).collect()}
    assert got == pytest.approx(by_hand(min_df, max_df, features))
    once = content.tfidf_fit_transform(docs, features, min_df, max_df)[1]
    assert {(r["book_id"], r["term"]): r["weight"] for r in once.collect()} == pytest.approx(got)


def test_fit_sample(spark, docs):
    assert content.fit_sample(docs, "all").count() == 4
    assert content.fit_sample(docs.unionByName(spark.createDataFrame([(9, "  ")], docs.schema)), None).count() == 4
    first, again = ({r[0] for r in content.fit_sample(docs.repartition(n), 2).collect()} for n in (1, 3))
    assert first == again and len(first) == 2


def test_stratified_sample(spark):
    df = spark.range(100).withColumn("s", F.when(F.col("id") < 61, "a").when(F.col("id") < 90, "b").otherwise("c"))
    drawn = content.stratified_sample(df, "s", "id", 10)
    assert {r["s"]: r["count"] for r in drawn.groupBy("s").count().collect()} == {"a": 6, "b": 3, "c": 1}
    assert {r["id"] for r in drawn.collect()} == {r["id"] for r in content.stratified_sample(df.repartition(7), "s", "id", 10).collect()}
    assert content.stratified_sample(df, "s", "id", 1000).count() == 100


def test_content_text(spark):
    df = spark.createDataFrame(
        [("T", "A", "g | h", "d" * 40, "en-US", 1987), ("T", None, None, "short", None, 30)],
        "title string, primary_author string, genre_names string, description string, language_code string, publication_year int",
    )
    long, short = [r["content_text"] for r in content.content_text(df).collect()]
    assert long == "T T T A A g | h g | h " + "d" * 40 + " language_en-us decade_1980"
    assert short.split() == ["T", "T", "T"]


def test_svd_matches_dense(spark):
    rng = np.random.default_rng(1)
    dense = (rng.random((60, 20)) * (rng.random((60, 20)) < 0.4)) @ np.diag(np.linspace(3, 0.2, 20))
    cells = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
    weights = spark.createDataFrame(cells, "book_id long, term_index int, weight double").repartition(5)
    model = svd.truncated_svd(weights, 20, 4, n_iter=10)
    _, values, right = np.linalg.svd(dense, full_matrices=False)
    assert model.singular_values == pytest.approx(values[:4], rel=1e-6)
    assert model.basis @ model.basis.T == pytest.approx(right[:4].T @ right[:4], abs=1e-5)
    scores = dense @ model.basis
    want = scores.var(axis=0).sum() / dense.var(axis=0).sum()
    assert svd.explained_variance(model) == pytest.approx(want, rel=1e-6)
    got = {r["book_id"]: np.array(r["vector"]) for r in svd.svd_project(model, weights).collect()}
    for i, vector in got.items():
        assert vector == pytest.approx(scores[i] / np.linalg.norm(scores[i]), abs=1e-9)
    with pytest.raises(ValueError):
        svd.truncated_svd(weights, 20, 20)


def test_svd_sums_once_a_core(spark, monkeypatch):
    """However many files the rows have, there are as many sums of the basis' size as cores; blocks of any size give them."""
    rng = np.random.default_rng(2)
    dense = rng.random((90, 12)) * (rng.random((90, 12)) < 0.5)
    rows = spark.createDataFrame(
        [(np.flatnonzero(r).tolist(), r[r > 0].tolist()) for r in dense], "terms array<int>, weights array<double>").repartition(40)
    basis = rng.standard_normal((12, 3))
    shared = spark.sparkContext.broadcast(basis)
    assert svd._partial_sums(rows, shared).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert svd._pass(rows, basis) == pytest.approx(dense.T @ (dense @ basis), abs=1e-9)
    batch = rows.toArrow().combine_chunks().to_batches()[0]
    for cells in (1, 30, 1 << 20):
        monkeypatch.setattr(svd, "CELLS", cells)
        held = np.zeros((90, 12))
        for part, seen, block in svd._blocks(batch, 12):
            assert block.size <= max(cells, 12)
            held[part][:, seen] = block
        assert sorted(map(tuple, held.round(9))) == sorted(map(tuple, dense.round(9)))


def test_texts_move_once(spark, docs):
    """From the texts to packed rows the plan has one exchange by document, of tokens, and none of terms."""
    model, _ = content.tfidf_fit_transform(docs, 100, 1, 1.0)
    packed = svd.sparse_rows(content.tfidf_transform(model, docs))
    assert packed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_density(docs):
    model, weights = content.tfidf_fit_transform(docs, 100, 1, 1.0)
    row = content.matrix_density(weights, 4, model.vocabulary.count()).first()
    assert row["density"] == pytest.approx(row["nonzero_values"] / (4 * row["columns"]))


def test_samples_equal_full_ranking(spark):
    """A third of the rows in one stratum, a null stratum, strata that want nothing, all or one row."""
    from lectern.operators.ranking import first_rows

    data = [(i, "hot" if i % 3 == 0 else None if i % 31 == 0 else f"s{i % 7}", i % 5) for i in range(3000)]
    df = spark.createDataFrame(data, "id bigint, s string, value int").repartition(5)
    wanted = {"hot": 700, "s0": 0, "s1": 1, "s2": 10_000, "s3": 33, "absent": 4}
    take = spark.createDataFrame(list(wanted.items()), "s string, _take bigint")
    code = F.xxhash64("id", F.lit(42))
    codes = dict(df.select("id", code).collect())
    got = {}
    # bins of few values, so that the last one holds many rows to rank
    for shift in (52, 62):
        bins = [F.shiftright(code, shift), F.shiftright(code, shift - 2).bitwiseAND(F.lit(3)) if shift == 62 else F.shiftright(code, 40).bitwiseAND(F.lit(0xFFF))]
        drawn = first_rows(df, ["s"], take, bins, [code.asc(), F.col("id").asc()]).collect()
        got[shift] = sorted((r["s"], r["id"]) for r in drawn)
    want = sorted(
        (s, i) for s, n in wanted.items() for i in sorted((i for i, t, _ in data if t == s), key=lambda i: (codes[i], i))[:n])
    assert got[52] == want and got[62] == want
    assert first_rows(df.limit(0), ["s"], take, [F.lit(0), F.lit(0)], [F.col("id").asc()]).count() == 0
