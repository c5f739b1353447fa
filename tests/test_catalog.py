import pytest
from pyspark.sql import functions as F

from lectern.operators import catalog as ops, popularity as pop, quality


@pytest.fixture(scope="module")
def books(spark):
    authors = "array<struct<author_id:string,role:string>>"
    data = [
        ("7", "1", " A title ", "", "x" * 40, "4.5", "10", "3", "1999", [("1", ""), ("2", "Editor")]),
        ("8", "1", "B", None, "short", "4.0", "10", "5", "1.7", [("2", "")]),
        ("9", None, "  ", None, None, None, None, None, None, []),
        ("x", "1", "bad id", None, None, "3", "5", "1", None, [("1", "")]),
        ("1.7", "1", "rounded id", None, None, "9.0", "5", "1", None, [(None, "")]),
        (None, "1", "no id", None, None, "3", "5", "1", None, None),
    ]
    names = "book_id string, work_id string, title string, title_without_series string, description string, average_rating string, ratings_count string, text_reviews_count string, publication_year string"
    df = spark.createDataFrame(data, f"{names}, authors {authors}")
    return df.withColumns({c: F.lit(None).cast("string") for c in ("publisher", "language_code", "isbn", "isbn13", "url", "image_url")})


@pytest.fixture(scope="module")
def authors(spark):
    return spark.createDataFrame([("1", "Ann"), ("2", "")], "author_id string, name string")


def test_bridge_and_summary(books, authors):
    bridge = ops.author_bridge_join(ops.author_bridge(books), authors)
    got = {(r["book_id"], r["author_position"]): (r["author_name"], r["author_role"]) for r in bridge.collect()}
    assert got == {(7, 0): ("Ann", None), (7, 1): ("Unknown author", "Editor"), (8, 0): ("Unknown author", None)}
    summary = {r["book_id"]: r for r in ops.author_summary(bridge).collect()}
    assert summary[7]["author_names"] == "Ann, Unknown author" and summary[7]["primary_author_id"] == 1
    assert summary[7]["author_count"] == 2


def test_bridge_reads_json_text(spark):
    df = spark.createDataFrame([("1", '[{"author_id":"5","role":"Translator"}]'), ("2", "not json"), ("3", None)], "book_id string, authors string")
    assert [tuple(r) for r in ops.author_bridge(df).collect()] == [(1, 5, "Translator", 0)]
    genres = spark.createDataFrame([("1", '{" a ":"2","b":null,"  ":"4"}'), ("2", "[")], "book_id string, genres string")
    got = sorted(tuple(r) for r in ops.genre_bridge(genres).collect())
    assert got == [(1, "a", 2, 1), (1, "b", 0, 2)]


def test_genre_rank_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("1", {"z": 3, "a": 3, "m": 9}), ("2", {})], "book_id string, genres map<string,bigint>")
    for split_rows in (1, 1000):
        got = {r["genre_name"]: r["genre_rank"] for r in ops.genre_bridge(df, split_rows).collect()}
        assert got == {"m": 1, "a": 2, "z": 3}


def test_edition_rank(books):
    for split_rows in (1, 1000):
        got = {r["book_id"]: (r["work_key"], r["edition_rank"]) for r in ops.edition_rank(books, split_rows).collect()}
        assert got == {8: (1, 1), 7: (1, 2), 2: (1, 3), 9: (-9, 1)}


def test_build_catalog(spark, books, authors):
    genres = spark.createDataFrame([("7", {"g": 1})], "book_id string, genres map<string,bigint>")
    works = spark.createDataFrame([("1", "4", "100", " O ", "1990", None, None)], "work_id string, books_count string, ratings_count string, original_title string, original_publication_year string, original_publication_month string, original_publication_day string")
    id_map = spark.createDataFrame([("70", "7")], "book_id_csv string, book_id string")
    full = {r["book_id"]: r for r in ops.build_catalog(books, authors, genres, works, id_map).collect()}
    assert set(full) == {7, 8, 9, 2}
    seven = full[7]
    assert (seven["title"], seven["interaction_book_id"], seven["primary_genre"], seven["original_title"]) == ("A title", 70, "g", "O")
    assert seven["has_usable_description"] and not full[8]["has_usable_description"] and seven["title_key"] == "a title"
    assert full[8]["publication_year"] == 2 and full[9]["title"] is None and full[9]["author_count"] == 0
    assert full[9]["bayesian_rating"] is None and full[9]["novelty_score"] == 1.0
    # mean of the ratings within 0-5 of rated rows, votes at the 0.9 quantile: 3 rows with readable ratings
    mean, votes = ops.scoring_literals(books)
    assert mean == pytest.approx((4.5 + 4.0 + 3 + 3) / 4) and votes == pytest.approx(10.0)
    table = spark.createDataFrame([(r["book_id"],) for r in full.values()], "book_id long")
    assert quality.q_unique_book(table).first()["passed"]
    assert not quality.q_unique_book(table.unionByName(table.limit(1))).first()["passed"]


def test_author_rankings_and_lists(spark):
    data = [
        (1, "a", 10, 4.0, 4.1, 0.9, "x", "en"), (2, "a", 10, 2.0, 4.1, None, "y", " "), (3, "a", 20, None, None, 0.5, "y", None),
        (4, "b", 50, 5.0, 4.9, 0.8, "x", "en"), (5, None, 60, 5.0, 4.0, 0.8, None, "en"),
    ]
    scored = spark.createDataFrame(data, "book_id long, primary_author string, ratings_count long, average_rating double, bayesian_score double, wilson_score double, primary_genre string, language_code string").withColumns(
        {"title": F.concat(F.lit("t"), F.col("book_id").cast("string")), "primary_author_id": F.lit(1), "novelty_score": F.lit(0.5)}
    )
    ranked = pop.author_rankings(scored).collect()
    assert len(ranked) == 1
    assert (ranked[0]["median_rating"], ranked[0]["best_ranked_book"], ranked[0]["total_ratings"]) == (3.0, "t1", 40)
    order = [r["book_id"] for r in pop.rank_overall(scored, 3, 10).orderBy("rank").collect()]
    assert order == [4, 1, 2]
    assert {(r["book_id"], r["genre_rank"]) for r in pop.rank_by_genre(scored, 1, 0).collect()} == {(4, 1), (1, 1)} - {(1, 1)} | {(2, 1)}
    assert {r["book_id"] for r in pop.rank_by_language(scored, 5, 0).collect()} == {1, 4, 5}
    assert [r["book_id"] for r in pop.hidden_gems(scored, 4.0, 10, 50).orderBy("hidden_gem_rank").collect()] == [1, 4]
    assert [r["book_id"] for r in pop.safe_choices(scored, 4.0, 50).orderBy("safe_choice_rank").collect()] == [4, 5]


@pytest.mark.parametrize("book", [2**53 + 1, 2**63 - 1])
def test_wide_ids_stay_exact(spark, book):
    """Two neighbouring ids above 2^53 stay two books through every step of the catalog."""
    pair = [str(book), str(book - 1)]
    books = spark.createDataFrame(
        [(b, pair[0], [(pair[1], "")], "t", "", "d" * 50, "4.0", "3", "1", "1990", "en", None, None, None, None, None) for b in pair],
        "book_id string, work_id string, authors array<struct<author_id:string,role:string>>, title string, title_without_series string, "
        "description string, average_rating string, ratings_count string, text_reviews_count string, publication_year string, "
        "language_code string, publisher string, isbn string, isbn13 string, url string, image_url string")
    wanted = {int(b) for b in pair}
    assert {(r.book_id, r.author_id) for r in ops.author_bridge(books).collect()} == {(b, book - 1) for b in wanted}
    genres = spark.createDataFrame([(b, {"g": "1"}) for b in pair], "book_id string, genres map<string,string>")
    assert {r.book_id for r in ops.genre_bridge(genres).collect()} == wanted
    assert {(r.book_id, r.work_key) for r in ops.edition_rank(books).collect()} == {(b, book) for b in wanted}
    authors = spark.createDataFrame([(pair[1], "N")], "author_id string, name string")
    ids = spark.createDataFrame([(pair[0], "5")], "book_id string, book_id_csv string")
    works = spark.createDataFrame([(pair[0], "2", "9", "o", "1", "2", "3")], "work_id string, books_count string, ratings_count string, "
                                  "original_title string, original_publication_year string, original_publication_month string, original_publication_day string")
    rows = {r.book_id: r for r in ops.build_catalog(books, authors, genres, works, ids).collect()}
    assert set(rows) == wanted and all(r.primary_author == "N" and r.work_books_count == 2 for r in rows.values())
    assert rows[book].interaction_book_id == 5 and rows[book - 1].interaction_book_id is None


def test_whole_numbers(spark):
    from lectern.functions.text import whole_number

    shown = ["12", " 12 ", "12.5", "-12.5", "12d", "1e3", "x", "", None, str(2**63 - 1), str(2**63), "NaN", "1.2e40"]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(shown)], "i int, s string").orderBy("i")
    got = [tuple(r) for r in rows.select(whole_number("s"), whole_number("s", rounded=False)).collect()]
    assert got == [(12, 12), (12, 12), (13, 12), (-13, -12), (None, None), (1000, 1000), (None, None), (None, None), (None, None),
                   (2**63 - 1, 2**63 - 1), (None, None), (None, None), (None, None)]
