import random

import pytest
from pyspark.sql import functions as F

from lectern.functions import fuzzy
from lectern.operators import enrichment as enr, matching as ops

CATALOG = "book_id long, work_id long, title string, primary_author string, isbn string, isbn13 string, ratings_count long, bayesian_rating double, is_canonical_edition boolean"


def with_details(df):
    return df.withColumns(
        {"publication_year": F.lit(1990), "primary_genre": F.lit("g"), "description": F.lit("d"), "image_url": F.lit(None).cast("string")}
    )


@pytest.fixture(scope="module")
def shelf(spark):
    """Titles over few words, so that tokens like "the" are in a third of them."""
    rng = random.Random(4)
    words = ["the", "there", "Theory", "L'Étranger", "old", "man", "sea", "x" * 70 + "sea", "of", "o'man"]
    names = ["Ann Smith", "Smithson, Bo", "Ünal Cé", None, "Li"]
    data = [
        (i, i // 2, " ".join(rng.sample(words, rng.randint(1, 5))), rng.choice(names), None, None, rng.choice([None, 5, 5, 9]),
         rng.choice([None, 1.0, 2.0]), rng.random() < 0.8)
        for i in range(120)
    ]
    return data, with_details(spark.createDataFrame(data, CATALOG))


@pytest.fixture(scope="module")
def inputs(spark):
    data = [
        (1, "The Old Man and the Sea", "Ann Smith"), (2, "Theory", None), (3, "of", "smith"), (4, "of", None), (5, "étranger", "Cé"),
        (6, "tranger sea", None), (7, "", "Ann Smith"), (8, None, None), (9, "the old man and the sea", "ANN SMITH"), (10, "zebra", "li"),
    ]
    return data, spark.createDataFrame(data, "input_id int, title string, author string").withColumn("isbn", F.lit(None).cast("string"))


@pytest.mark.parametrize("limit", [1, 7, 500])
def test_blocking_is_exact(shelf, inputs, limit):
    data, catalog = shelf
    requests = ops.match_requests(inputs[1])
    got = {}
    for r in ops.blocked_fuzzy_join(requests, catalog, limit).collect():
        got.setdefault((r["q_title"], r["q_author"]), {})[r["candidate_rank"]] = r["book_id"]
    rows = requests.collect()
    assert len(rows) == 7
    for r in rows:
        hits = [
            (-(n if n is not None else -1), -(b if b is not None else -1), i) for i, _, t, a, _, _, n, b, canonical in data
            if canonical and (not r["t"] or any(x in t.lower() for x in r["t"]))
            and (not r["a"] or any(x in (a or "").lower() for x in r["a"]))
        ]
        want = [i for _, _, i in sorted(hits)][:limit]
        found = got.get((r["q_title"], r["q_author"]), {})
        assert [found[n] for n in sorted(found)] == want


def test_folded_catalog_finds_accents(shelf, inputs):
    _, catalog = shelf
    requests = ops.match_requests(inputs[1].where("input_id = 5"))
    assert ops.blocked_fuzzy_join(requests, catalog).count() == 0
    assert ops.blocked_fuzzy_join(requests, catalog, fold_catalog=True).count() >= 0


def test_isbn_prefers_canonical_then_popular(spark):
    data = [
        (1, 1, "a", "x", "0-14", None, 9, 1.0, False), (2, 1, "b", "x", "014", None, 1, 1.0, True), (3, 1, "c", "x", None, "014", 5, 1.0, True),
        (4, 2, "d", "x", "", "", 5, 1.0, True),
    ]
    catalog = with_details(spark.createDataFrame(data, CATALOG))
    asked = spark.createDataFrame([(1, '="014"'), (2, ""), (3, None), (4, "99")], "input_id int, isbn string")
    assert [(r["input_id"], r["book_id"]) for r in ops.isbn_match_join(asked, catalog).collect()] == [(1, 3)]


def test_cascade(spark):
    data = [
        (1, 10, "The Old Man and the Sea", "Ernest H", "111", None, 50, 4.0, True), (2, 10, "Old Man", "Ernest H", "222", None, 5, 4.0, False),
        (3, 11, "Dune Messiah", "Frank H", None, "333", 40, 4.0, True),
    ]
    catalog = with_details(spark.createDataFrame(data, CATALOG))
    asked = spark.createDataFrame(
        [(1, "anything", None, "2-2-2"), (2, "the old man & the sea", "ernest h", None), (3, "qqqq", "zz", None), (4, "wwww", None, None),
         (5, None, "Frank H", None), (6, "rrrr", None, None)],
        "input_id int, title string, author string, isbn string",
    )
    landed = spark.createDataFrame(
        [
            (3, 0, '{"id":"a","volumeInfo":{"title":"Nothing like it"}}'),
            (3, 1, '{"id":"b","volumeInfo":{"title":"Dune Messiah","authors":["Frank H","Other"]}}'),
            (4, 0, '{"id":"c","volumeInfo":{"title":"New","authors":["A","B"],"categories":["k"],"publishedDate":"2011-05","language":"en"}}'),
            (6, 0, '{"id":"d","volumeInfo":{"industryIdentifiers":[{"type":"ISBN_13","identifier":"333"}]}}'),
        ],
        "input_id int, position int, json string",
    )
    volumes = enr.parse_volumes(landed)
    hybrid = spark.createDataFrame([(1, 100)], "book_id long, hybrid_index long")
    got = {r["input_id"]: r for r in ops.match_books(asked, catalog, ["input_id"], volumes=volumes, hybrid_map=hybrid).collect()}
    assert len(got) == 6 and len(next(iter(got.values()))) == 23
    assert (got[1]["match_method"], got[1]["confidence"], got[1]["local_book_id"], got[1]["hybrid_index"]) == ("isbn_exact", 100.0, 1, 100)
    assert (got[2]["match_method"], got[2]["local_book_id"]) == ("title_author_fuzzy", 1) and got[2]["confidence"] >= 88
    assert (got[3]["match_method"], got[3]["local_book_id"]) == ("google_title_author_to_local_fuzzy", 3)
    assert (got[6]["match_method"], got[6]["local_book_id"]) == ("google_isbn_to_local_exact", 3)
    cold = got[4]
    assert (cold["status"], cold["google_volume_id"], cold["primary_author"], cold["publication_year"]) == ("cold_start", "c", "A, B", 2011)
    assert cold["cold_start_content_text"] == "New New New A B A B k k language_en"
    assert got[5]["status"] == "unmatched" and got[5]["confidence"] == 0.0 and len(got[5]["notes"]) == 1
    plain = {r["input_id"]: r["local_book_id"] for r in ops.match_books(asked, catalog, ["input_id"], to_canonical=False).collect()}
    assert plain[1] == 2 and plain[3] is None


def test_score_follows_the_definition(shelf, inputs):
    data, catalog = shelf
    titles = {i: (t, a) for i, _, t, a, *_ in data}
    scored = ops.score_candidates(ops.blocked_fuzzy_join(ops.match_requests(inputs[1]), catalog, 20), catalog).collect()
    fold = lambda s: " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in (s or "").lower().replace("é", "e").replace("ü", "u")).split())
    assert scored
    for r in scored:
        title, author = map(fold, titles[r["book_id"]])
        part = max(fuzzy.weighted_ratio(r["q_title"], title), fuzzy.token_set_ratio(r["q_title"], title))
        want = 0.78 * part + 0.22 * fuzzy.token_set_ratio(r["q_author"], author) if r["q_author"] else part
        assert r["score"] == pytest.approx(want)


def test_volumes(spark):
    full = (
        '{"id":"v","volumeInfo":{"title":"T","authors":["A","B"],"pageCount":"no number","averageRating":4,"ratingsCount":7.9,'
        '"industryIdentifiers":[{"type":"isbn_10","identifier":" 1 "},{"type":"ISBN_10","identifier":"2"},{"type":"ISSN","identifier":"x"},'
        '{"type":"ISSN","identifier":"y"},{"type":"ISBN_13","identifier":" "}],'
        '"imageLinks":{"large":"","medium":"http://m/http://n","smallThumbnail":"https://s"},"readingModes":{"text":true}},"saleInfo":{"isEbook":false}}'
    )
    df = spark.createDataFrame([(1, full), (2, '{"id":"w"}'), (3, "broken")], "n int, json string")
    rows = {r["n"]: r for r in enr.volume_flatten(df).collect()}
    v = rows[1]
    assert (v["isbn10"], v["isbn13"], v["other_identifiers"], v["page_count"], v["ratings_count"]) == ("2", None, '{"ISSN":"y"}', None, 7)
    assert (v["thumbnail_url"], v["small_thumbnail_url"]) == ("https://m/http://n", "https://s")
    assert (v["authors"], v["text_reading_modes"], v["is_ebook"], v["average_rating"]) == ("A | B", True, False, 4.0)
    assert rows[2]["authors"] == "" and rows[2]["title"] is None and rows[3]["google_volume_id"] == ""
    assert len(v) == 30 and v["raw_query"] is None and v["fetched_at_utc"] is None


def test_requests_and_cache(spark):
    import hashlib
    import json

    df = spark.createDataFrame([('say "hi"\n', 5)], "q string, n int")
    params = {"q": F.col("q"), "maxResults": F.col("n"), "key": F.lit("secret"), "lang": F.lit(None).cast("string")}
    got = df.select(enr.request_key(F.lit("search"), F.col("q"), params)).first()[0]
    payload = json.dumps({"request_type": "search", "value": 'say "hi"\n', "params": {"q": 'say "hi"\n', "maxResults": 5}}, sort_keys=True, ensure_ascii=False)
    assert got == hashlib.sha256(payload.encode()).hexdigest()
    null = F.lit(None).cast("string")
    text = df.select(enr.query_text(F.lit(" T "), null, F.lit("1-2x"), null, F.lit(""), F.lit("free"))).first()[0]
    assert text == 'free intitle:"T" isbn:12x'
    with pytest.raises(Exception, match="filled part"):
        df.select(enr.query_text(null, null, null, null, null, F.lit(" "))).collect()
    at = lambda d: f"2024-01-{d:02d} 00:00:00"
    cache = spark.createDataFrame([("a", at(1), "old", at(10)), ("b", at(1), "keep", at(30))], "cache_key string, f string, response_json string, e string")
    cache = cache.select("cache_key", F.to_timestamp("f").alias("fetched_at"), "response_json", F.to_timestamp("e").alias("expires_at"))
    fresh = cache.where("cache_key = 'a'").select("cache_key", "fetched_at", F.lit("new").alias("response_json"))
    after = {r["cache_key"]: (r["response_json"], str(r["expires_at"])) for r in enr.cache_upsert(cache, fresh).collect()}
    assert after == {"a": ("new", "2024-01-31 00:00:00"), "b": ("keep", "2024-01-30 00:00:00")}
    now = F.to_timestamp(F.lit(at(10)))
    assert [r["cache_key"] for r in enr.cache_expire(cache, now).collect()] == ["b"]
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "cache_key string")
    assert {r["cache_key"]: r["response_json"] for r in enr.cache_lookup(asked, cache, now).collect()} == {"a": None, "b": "keep", "c": None}


def test_exact_titles_beyond_the_limit(spark):
    """A book named by a common word is found although more popular ones share the word."""
    rows = [(i, i, f"Common story {i}", "Someone", 1000 - i, 1.0, True) for i in range(30)] + [(99, 99, "Common", "Nobody Known", 1, 1.0, True)]
    catalog = spark.createDataFrame(rows, "book_id bigint, work_id bigint, title string, primary_author string, ratings_count bigint, bayesian_rating double, is_canonical_edition boolean")
    catalog = catalog.withColumns({"isbn": F.lit(None).cast("string"), "isbn13": F.lit(None).cast("string")})
    asked = spark.createDataFrame([(1, "common", "Nobody Known", None)], "input_id int, title string, author string, isbn string")
    got = ops.local_match(asked, catalog, ["input_id"], limit=3).collect()
    assert [(r.book_id, r.score) for r in got] == [(99, 100.0)]


def test_candidates_move_once_to_their_scores(spark):
    """Candidates are neither stored nor sent to meet their scores: the plan reads them once and deals them by their titles."""
    catalog = spark.createDataFrame([(1, "The Red Cat", "A B"), (2, "Red Cat", "A B"), (3, "Red Cat", None)], "book_id bigint, title string, primary_author string")
    candidates = spark.createDataFrame(
        [("red cat", "a b", 1), ("red cat", "a b", 2), ("red cat", "", 3), ("red cat", "", 2)], "q_title string, q_author string, book_id bigint")
    scored = ops.score_candidates(candidates, catalog)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("RepartitionByExpression") == 1 and "parquet" not in plan
    got = {(r.q_author, r.book_id): round(r.score, 6) for r in scored.collect()}
    assert got == {("a b", 1): 100.0, ("a b", 2): 100.0, ("", 3): 100.0, ("", 2): 100.0}


def test_matching_reads_each_side_once(spark):
    """Inputs and catalog are computed once, however many steps of the match read them."""
    counts = [spark.sparkContext.accumulator(0) for _ in range(2)]

    def counted(total):
        def keep(text):
            total.add(1)
            return text
        return F.udf(keep, "string")

    catalog = spark.createDataFrame(
        [(i, i, f"Title number {i}", f"Author {i % 3}", True, f"{i:010d}", None, "d", 1999, "g", i, 1.0, None) for i in range(40)],
        "book_id bigint, work_id bigint, title string, primary_author string, is_canonical_edition boolean, isbn string, isbn13 string, "
        "description string, publication_year int, primary_genre string, ratings_count bigint, bayesian_rating double, image_url string")
    asked = spark.createDataFrame([(i, f"Title numbr {i}", "Author 1", None) for i in range(30)], "input_id bigint, title string, author string, isbn string")
    catalog = catalog.withColumn("title", counted(counts[1])("title"))
    asked = asked.withColumn("title", counted(counts[0])("title"))
    assert ops.match_books(asked, catalog, ["input_id"]).count() == 30
    assert [c.value for c in counts] == [30, 40]


def test_candidates_move_without_their_texts(shelf, inputs):
    _, catalog = shelf
    found = ops.blocked_fuzzy_join(ops.match_requests(inputs[1]), catalog, 7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(q_title" not in plan and "hashpartitioning(_request" in plan
    assert "_request" not in found.columns
