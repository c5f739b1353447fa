import json
import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import explain as ex, library as lib, profile as prof, recommend as rec
from lectern.sources.readers import library_columns


@pytest.fixture(scope="module")
def export(spark):
    data = [
        (1, 0, "12.0", "Dune", "Frank H", "read", "5", "8", "2024/01/02", '="0140449132"', ""),
        (1, 1, "3", "DUNE!", "frank h", "Read ", "", "", "bad", '="0140449132"', ""),
        (1, 2, "", "Other", "", "currently-reading", "", "1", "", "", "fun, To Sell"),
        (1, 3, "", "Other", "", "currently-reading", "", "1", "", "", "fun"),
        (1, 4, "x", "", "No title", "read", "4", "1", "", "", ""),
        (1, 5, "9", "Dropped", "A", "dnf", "4", "1", "", "", ""),
        (2, 6, "1", "Dune", "Frank H", "to-read", "2", "1", "", "", ""),
    ]
    names = ["user_id", "source_row", "Book Id", "Title", "Author", "Exclusive Shelf", "My Rating", "Read Count", "Date Read", "ISBN", "Bookshelves"]
    return library_columns(spark.createDataFrame(data, names))


def test_clean_library(export):
    rows = lib.clean_library(export, ["user_id"], exclude=["to sell"]).collect()
    got = {(r["user_id"], r["library_row_id"]): r for r in rows}
    assert set(got) == {(1, 0), (1, 1), (2, 0)}
    # the lower book id of the two equal entries stays
    assert (got[1, 0]["source_row"], got[1, 0]["goodreads_book_id"], got[1, 0]["preference_weight"]) == (1, 3, 0.25)
    assert got[1, 0]["isbn"] == "0140449132" and got[1, 0]["date_read"] is None
    assert got[1, 1]["title"] == "Other" and got[1, 1]["source_row"] == 3 and got[1, 1]["profile_eligible"]
    assert got[2, 0]["preference_weight"] == -0.45 and not got[2, 0]["profile_eligible"] and got[2, 0]["exclusion_from_recommendations"]


def test_import_and_splits(spark, export):
    cleaned = lib.clean_library(export, ["user_id"])
    catalog = spark.createDataFrame([(7, 70, "Dune", "Frank H", "0140449132", 5, 4.0, True)], "book_id long, work_id long, title string, primary_author string, isbn string, ratings_count long, bayesian_rating double, is_canonical_edition boolean").withColumns(
        {"isbn13": F.lit(None).cast("string"), "publication_year": F.lit(1965), "primary_genre": F.lit("sf"), "description": F.lit(""), "image_url": F.lit("")}
    )
    imported = lib.import_library(cleaned, catalog, ["user_id"]).persist()
    assert imported.count() == cleaned.count() == 3
    splits = {k: v.count() for k, v in lib.split_by_status(imported, ["user_id"]).items()}
    assert splits == {"matched": 2, "cold_start": 0, "unmatched": 1, "profile_books": 2, "exclusion_books": 3}
    report = lib.import_report(imported).first()
    assert report["matched_rows"] == 2 and report["match_rate"] == pytest.approx(2 / 3)
    done = imported.where("user_id = 1")
    resumed = lib.import_library(cleaned, catalog, ["user_id"], done=done)
    assert sorted(map(str, resumed.collect())) == sorted(map(str, imported.collect()))


def test_profile_rows(spark):
    data = [
        (1, 1, 10, 1.0, "2024-01-01", True, "matched"), (1, 2, 11, -0.45, None, True, "matched"), (1, 3, 12, 0.04, None, True, "matched"),
        (1, 4, 13, 1.0, None, False, "matched"), (1, 5, 14, 1.0, None, True, "unmatched"), (1, 6, 15, 0.3, "2020-01-01", True, "matched"),
        (1, 7, 16, 1.0, "2030-01-01", True, "matched"),
    ]
    rows = spark.createDataFrame(data, "user_id int, library_row_id int, local_book_id long, preference_weight double, date_read string, profile_eligible boolean, match_status string")
    kept = {r["library_row_id"]: r["effective_weight"] for r in prof.profile_rows(rows, "2024-01-31", 30.0).collect()}
    assert kept == pytest.approx({1: 0.5, 2: -0.45, 7: 1.0})
    assert {r["library_row_id"] for r in prof.profile_rows(rows, "2024-01-31", 0, positive_only=True).collect()} == {1, 6, 7}
    space = spark.createDataFrame([(10, [1.0, 0.0]), (11, [0.0, 1.0]), (16, [0.0, 0.0])], "book_id long, vector array<double>")
    made = prof.user_profile(prof.profile_rows(rows, "2024-01-31", 30.0), space, space).first()
    a = (0.5**2 + 0.45**2) ** 0.5
    assert made["content_vector"] == pytest.approx([0.5 / a, -0.45 / a])
    assert sum(x * x for x in made["vector"]) == pytest.approx(1)
    # scaling all weights changes nothing
    doubled = prof.profile_rows(rows.withColumn("preference_weight", F.col("preference_weight") * 2), "2024-01-31", 30.0)
    again = prof.user_profile(doubled.where("library_row_id <> 3"), space, space).first()
    assert again["vector"] == pytest.approx(made["vector"])


def candidates(spark, seed=3, users=3, n=60):
    rng = random.Random(seed)
    data = [
        (u, i, i // 2, rng.choice([None, "Ann", "ANN ", "Bo", "Cy", ""]), rng.choice(["Fantasy", "Poetry", None]), rng.choice(["en", "EN", None]),
         round(rng.random(), 3), rng.choice([None, 0, 10, 500]), rng.choice([None, 3.0, 4.5]))
        for u in range(users) for i in range(n)
    ]
    names = "user_id int, book_id long, work_id long, primary_author string, primary_genre string, language_code string, hybrid_similarity double, ratings_count long, bayesian_rating double"
    return data, spark.createDataFrame(data, names)


def test_filters_and_exclusions(spark):
    data, df = candidates(spark)
    kept = rec.candidate_filters(df, 10, "en", "fan", ["nn"]).collect()
    want = {
        (u, b) for u, b, w, a, g, l, s, n, q in data
        if (n or 0) >= 10 and (l or "").lower() == "en" and "fan" in (g or "").lower() and "nn" not in (a or "").lower()
    }
    assert {(r["user_id"], r["book_id"]) for r in kept} == want and want
    known = spark.createDataFrame([(0, 4, 2), (1, 9, None), (2, None, 5)], "user_id int, local_book_id long, work_id long")
    left = {(r["user_id"], r["book_id"]) for r in rec.exclusion_anti_join(df, known).collect()}
    assert {(0, 4), (0, 5), (1, 9), (2, 10), (2, 11)}.isdisjoint(left) and len(left) == 180 - 5
    assert rec.exclusion_anti_join(df, known, by_work=False).count() == 180 - 2


def test_rerank_cap_and_rank(spark):
    data, df = candidates(spark)
    ranked = rec.rerank_minmax(df, novelty=0.3)
    best = rec.output_rank(rec.author_cap(ranked, max_per_author=2), top=9).collect()
    for u in range(3):
        order = sorted(
            (r for r in ranked.where(F.col("user_id") == u).collect()),
            key=lambda r: (r["recommendation_score"] is None, -(r["recommendation_score"] or 0), -r["hybrid_similarity"], r["book_id"]),
        )
        counts, want = {}, []
        for r in order:
            key = (r["primary_author"] or "Unknown").strip().lower()
            if counts.get(key, 0) < 2 and len(want) < 9:
                counts[key] = counts.get(key, 0) + 1
                want.append(r["book_id"])
        assert [r["book_id"] for r in sorted((r for r in best if r["user_id"] == u), key=lambda r: r["rank"])] == want
    with pytest.raises(ValueError):
        rec.rerank_minmax(df, novelty=2)
    assert rec.quality_source(["average_rating", "wilson_lower_bound"]) == "wilson_lower_bound"


def brute_evidence(rows, evidence, max_uses, bonus, penalty=0.02):
    """Greedy selection spelled out for one user; rows are dictionaries."""
    uses, picks = {}, []
    for rank in sorted({r["rank"] for r in rows}):
        left = sorted(
            (r for r in rows if r["rank"] == rank and (max_uses <= 0 or uses.get(r["library_row_id"], 0) < max_uses)),
            key=lambda r: (-r["evidence_score"], -r["explanation_weight"], r["library_row_id"]),
        )
        cited, place = set(), 0
        while left and place < evidence:
            best, top = None, -1e9
            for r in left:
                key = (r["matched_author"] or r["input_author"] or "").strip().lower()
                score = r["evidence_score"] + (bonus if key and key not in cited else 0) - penalty * uses.get(r["library_row_id"], 0)
                if score > top + 1e-12:
                    best, top = r, score
            left.remove(best)
            place += 1
            cited.add((best["input_author"] or best["matched_author"] or "Unknown author").strip().lower())
            uses[best["library_row_id"]] = uses.get(best["library_row_id"], 0) + 1
            picks.append((rank, place, best["library_row_id"], uses[best["library_row_id"]]))
    return picks


# (evidence, max uses, bonus, recommendations); the last ones keep few of the candidates
@pytest.mark.parametrize("options", [(3, 5, 0.05, 8), (2, 1, 0.05, 8), (3, 0, 0.2, 8), (1, 1, 0.05, 2), (2, 2, 0.3, 3), (2, 0, 0.5, 2)])
def test_evidence_select(spark, options):
    evidence, max_uses, bonus, recommendations = options
    rng = random.Random(11)
    books = [
        dict(library_row_id=i, explanation_weight=rng.choice([0.2, 0.5, 1.0]), my_rating=float(rng.randint(0, 5)),
             input_title=f"t{i}", matched_title=None, input_author=rng.choice(["Ann", "ann ", "Bo", None]),
             matched_author=rng.choice(["Ann", "Bo", "Cy", "", None]))
        for i in range(40)
    ]
    rows = [
        dict(b, user_id=u, rank=k, content_similarity=0.5, evidence_score=round(rng.random(), 2), shared_genre=False, shared_author=True)
        for u in range(2) for k in range(1, recommendations + 1) for b in books if rng.random() < 0.7
    ]
    schema = "library_row_id int, explanation_weight double, my_rating double, input_title string, matched_title string, input_author string, matched_author string, user_id int, rank int, content_similarity double, evidence_score double, shared_genre boolean, shared_author boolean"
    names = [c.split()[0] for c in schema.split(", ")]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
    got = ex.evidence_select(df, evidence, max_uses, bonus, max_recommendations=recommendations).collect()
    if recommendations <= 3:
        assert ex.prune_evidence(df, evidence, recommendations, bonus).count() < len(rows)
    for u in range(2):
        mine = sorted((r["rank"], r["evidence_rank"], r["library_row_id"], r["global_usage_count"]) for r in got if r["user_id"] == u)
        assert mine == brute_evidence([r for r in rows if r["user_id"] == u], evidence, max_uses, bonus)
    if max_uses:
        assert max(r["global_usage_count"] for r in got) <= max_uses


def test_explain(spark):
    recs = spark.createDataFrame(
        [(1, 1, 100, "Rec", "Ann", "sf", 4.25, 3, 0.5, 0.9), (1, 2, 101, "Far", None, None, None, 20000, 0.4, 0.8), (1, 3, 102, "", None, None, 1.0, 1, None, None)],
        "user_id int, rank int, book_id long, title string, primary_author string, primary_genre string, bayesian_rating double, ratings_count long, hybrid_similarity double, recommendation_score double",
    )
    profile = spark.createDataFrame(
        [(1, 1, 1, 1.0, "One", "Ann", "ann", "SF", 5.0), (1, 2, 2, 0.1, "Weak", "Bo", None, None, 3.0), (1, 3, 3, 0.5, "Three", "Unknown author", None, None, 4.0)],
        "user_id int, library_row_id int, local_book_id long, effective_weight double, input_title string, input_author string, matched_author string, matched_primary_genre string, my_rating double",
    )
    content = spark.createDataFrame([(100, [1.0, 0.0]), (101, [0.0, -1.0]), (1, [0.8, 0.6]), (2, [1.0, 0.0]), (3, [0.6, 0.8])], "book_id long, vector array<double>")
    told = {r["rank"]: r for r in ex.explain(recs, profile, content, model_details=True).collect()}
    first = told[1]
    assert first["short_explanation"] == "Related to One by Ann and Three (content similarities: 0.80, 0.60)"
    assert first["explanation"] == (
        "It is close in content to books you liked, especially One by Ann, Three; it reinforces your apparent interest in sf; "
        "you have already shown interest in Ann; it also has a strong reader rating of 4.25; model evidence: hybrid similarity 0.500, final score 0.900."
    )
    cited = json.loads(first["evidence_books"])
    assert [c["title"] for c in cited] == ["One", "Three"] and cited[0]["evidence_score"] == pytest.approx(1.0)
    assert first["evidence_book_count"] == 2 and first["strongest_evidence_similarity"] == pytest.approx(0.8)
    assert told[2]["evidence_books"] == "[]" and told[2]["short_explanation"] == "Strong hybrid-profile match"
    assert told[2]["explanation"].startswith("It has substantial reader support; model evidence: ")
    assert told[3]["explanation"].startswith("This book by an unknown author was selected because")


def test_reason(spark):
    df = spark.createDataFrame([(0.12345, "sf", None, 3.125), (0.5, " ", None, None)], "hybrid_similarity double, primary_genre string, bayesian_rating double, average_rating double")
    assert [r[0] for r in df.select(rec.recommendation_reason()).collect()] == ["hybrid similarity 0.123; genre: sf; rating 3.12", "hybrid similarity 0.500"]


@pytest.mark.parametrize("filters", [{}, {"genre": "odd"}])
def test_readers_with_many_known_books_get_full_lists(spark, filters):
    """40 of the 50 nearest books are known or of the wrong genre, and the pool is small: the list is still full."""
    rng = random.Random(3)
    books = [(b, [1.0, b / 100 + rng.random() / 1000], b, "odd" if b % 2 else "even", f"a{b}", b) for b in range(100)]
    frame = spark.createDataFrame(books, "book_id bigint, vector array<double>, work_id bigint, primary_genre string, primary_author string, ratings_count bigint")
    readers = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.5])], "user_id bigint, vector array<double>")
    known = spark.createDataFrame([(1, b, b) for b in range(40)], "user_id bigint, local_book_id bigint, work_id bigint")
    got = rec.recommend(readers, frame.select("book_id", "vector"), frame.drop("vector"), known, pool=10, top=10, max_per_author=0, **filters).collect()
    for user in (1, 2):
        found = {r.book_id for r in got if r.user_id == user}
        allowed = [b for b in range(100) if (b >= 40 or user == 2) and (b % 2 or not filters)]
        by_angle = sorted(allowed, key=lambda b: -(1 + books[b][1][1] * (0.5 if user == 2 else 0)) / (1 + books[b][1][1] ** 2) ** 0.5)
        assert found == set(by_angle[:10])


def test_added_date_stands_in_for_the_reading_date(spark):
    rows = spark.createDataFrame([(1, 1.0, None, "2024-01-01"), (2, 1.0, "2024-01-31", "2020-01-01"), (3, 1.0, None, None)],
                                 "library_row_id int, preference_weight double, date_read string, date_added string")
    got = {r.library_row_id: round(r.recency_multiplier, 6) for r in prof.profile_rows(rows, "2024-01-31", 30.0).collect()}
    assert got == {1: 0.5, 2: 1.0, 3: 1.0}


def test_known_books_leave_in_one_exchange(spark):
    """By book and by work, with nulls on both sides and repeated rows; what follows by user needs no other exchange."""
    candidates = [(1, 10, 5), (1, 10, 5), (1, 11, 5), (1, 12, None), (1, 13, 6), (2, 10, 5), (2, None, 6), (None, 10, 5), (3, 14, None), (3, None, None)]
    known = [(1, 10, None), (1, None, 6), (2, 99, 6), (None, 10, 5), (3, None, None), (3, 15, 7), (3, 15, 7)]
    rows = spark.createDataFrame(candidates, "user_id long, book_id long, work_id long").withColumn("hybrid_similarity", F.lit(0.5))
    gone = spark.createDataFrame(known, "user_id int, local_book_id long, work_id long")
    by_work = rec.exclusion_anti_join(rows, gone)
    kept = lambda df: sorted(((r.user_id, r.book_id, r.work_id) for r in df.collect()), key=str)
    want = [(1, 11, 5), (1, 12, None), (2, 10, 5), (None, 10, 5), (3, 14, None), (3, None, None)]
    assert kept(by_work) == sorted(want, key=str) and by_work.dtypes == rows.dtypes
    assert kept(rec.exclusion_anti_join(rows, gone, by_work=False)) == sorted([*want, (1, 13, 6), (2, None, 6)], key=str)
    ranked = rec.author_cap(rec.rerank_minmax(by_work.withColumn("primary_author", F.lit("a"))), max_per_author=1)
    assert ranked._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(") == 1
