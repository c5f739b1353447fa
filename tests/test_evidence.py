"""Recommendations and citable books of a user meet in blocks."""

import random

import numpy as np
import pytest

from lectern.operators import explain as ex


@pytest.mark.parametrize("blocks", [(4096, 512, 50_000), (3, 2, 10)])
def test_pairs_like_all_pairs(spark, monkeypatch, blocks):
    for name, value in zip(("ROW_BLOCK", "REC_BLOCK", "PART_ROWS"), blocks):
        monkeypatch.setattr(ex, name, value)
    rng = random.Random(8)
    vectors = {b: [rng.gauss(0, 1) for _ in range(6)] for b in range(40)}
    vectors[7] = [0.0] * 6  # no direction: takes no part
    content = spark.createDataFrame([(b, v) for b, v in vectors.items()], "book_id long, vector array<double>")
    recs = [(u, k + 1, b) for u in (1, 2, 3, 5) for k, b in enumerate(rng.sample(range(45), 9 if u > 1 else 30))] + [(None, 1, 3)]
    rows = [(u, i, b) for i, (u, b) in enumerate((u, rng.randrange(45)) for u in [1] * 40 + [2] * 3 + [3, 4, None])]
    rec_df = spark.createDataFrame(recs, "user_id int, rank int, book_id long")
    row_df = spark.createDataFrame(rows, "user_id int, library_row_id int, local_book_id long")
    unit = {b: np.array(v) / np.linalg.norm(v) for b, v in vectors.items() if any(v)}
    want = {(u, b, c): float(unit[b] @ unit[c]) for u, _, b in recs for w, _, c in rows if u is not None and u == w and b in unit and c in unit}
    for least in (None, 0.05, 2.0):
        got = {(r.user_id, r.book_id, r.local_book_id): r.content_similarity for r in ex.similar_books(rec_df, row_df, content, least).collect()}
        kept = {k: v for k, v in want.items() if least is None or v >= least}
        assert got.keys() == kept.keys() and all(abs(got[k] - kept[k]) < 1e-12 for k in got)
    shown = rec_df.selectExpr("*", "'g' AS primary_genre", "'a' AS primary_author")
    pairs = ex.evidence_cross_join(shown, row_df, content)
    assert "vector" not in " ".join(pairs.columns)
    assert pairs.count() == sum((u, b, c) in want for u, _, b in recs for w, _, c in rows if u is not None and u == w)
    assert ex.similar_books(rec_df.limit(0), row_df, content).count() == 0


def test_vectors_move_as_they_are_given(spark):
    content = spark.createDataFrame(
        [(1, [3.0, 4.0]), (2, [4.0, 3.0]), (3, None), (4, [float("inf"), 1.0]), (5, [0.0, 0.0])], "book_id long, vector array<float>")
    recs = spark.createDataFrame([(1, 1), (1, 3), (1, 4), (1, 5)], "user_id int, book_id long")
    rows = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (1, 5), (2, 2)], "user_id int, local_book_id long")
    found = ex.similar_books(recs, rows, content)
    assert "ArrowEvalPython" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.user_id, r.book_id, r.local_book_id, round(r.content_similarity, 9)) for r in found.collect()] == [(1, 1, 2, 0.96)]


def test_short_explanation_cites_the_selected_books(spark, monkeypatch):
    from lectern.plans import personal_queries as plans

    content = spark.createDataFrame([(b, [1.0, b / 10]) for b in range(6)], "book_id long, vector array<double>")
    told = [(1, 1, 0, "t", "a", "g", 0.9), (2, 1, 0, "t", "a", "g", 0.9)]
    recs = spark.createDataFrame(told, "user_id int, rank int, book_id long, title string, primary_author string, primary_genre string, hybrid_similarity double")
    rows = [(1, b, b, 1.0, f"book {b}", f"writer {b}", f"book {b}", f"writer {b}", "h", 5) for b in (1, 2, 3)]
    pool = spark.createDataFrame(
        rows, "user_id int, library_row_id long, local_book_id long, explanation_weight double, input_title string, input_author string, "
        "matched_title string, matched_author string, matched_primary_genre string, my_rating int")
    for name, made in (("recommended", recs), ("pool", pool), ("content_space", content)):
        monkeypatch.setattr(plans, name, lambda inp, made=made: made)
    found = {r["user_id"]: r["short_explanation"] for r in plans.short_explanation(None).collect()}
    assert found == {
        1: "Related to book 1 by writer 1 and book 2 by writer 2 (content similarities: 1.00, 0.98)", 2: "Strong hybrid match in g"}
