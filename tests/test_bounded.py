import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.functions import fuzzy
from lectern.operators import bounded, matching as ops

CATALOG = "book_id long, work_id long, title string, primary_author string, isbn string, isbn13 string, ratings_count long, bayesian_rating double, is_canonical_edition boolean"
WORDS = ["the", "a", "old", "odd", "man", "men", "sea", "seas", "theory", "o", "of", "night", "knight", "x1", "garden", "gardens", "and"]


def texts(rng, n, most):
    return [" ".join(rng.choices(WORDS, k=rng.randint(0, most))) for _ in range(n)]


def edited(rng, text):
    at = rng.randint(0, len(text))
    return " ".join((text[:at] + rng.choice(["", "e", " z", "9"]) + text[at + rng.randint(0, 2):]).split())


def test_no_score_is_over_its_bound():
    rng = random.Random(7)
    a = texts(rng, 60, 4) + texts(rng, 40, 14)
    b = texts(rng, 60, 5) + texts(rng, 40, 30) + [edited(rng, t) for t in a] + ["man", "man old odd", "sea man"]
    people = ["", "ann smith", "smith ann", "smithson bo", "li"]
    qa, ca = [rng.choice(people) for _ in a], [rng.choice(people) for _ in b]
    pairs = [(x, y) for x in a for y in b]
    titles = fuzzy.title_scores([x for x, _ in pairs], [y for _, y in pairs]).reshape(len(a), len(b))
    left, right = bounded.Side(a), bounded.Side(b)
    bounds = bounded.title_bounds(left, right)
    assert (titles <= bounds + 1e-3).all()
    assert (bounds[titles == 100] >= 100 - 1e-3).all() and (bounds < 80).mean() > 0.3  # and it does exclude pairs
    authors = np.array([[fuzzy.token_set_ratio(x, y) if x else 0.0 for y in ca] for x in qa])
    assert (authors <= bounded.author_bounds(bounded.Side(qa), bounded.Side(ca)) + 1e-3).all()
    scores = np.where(np.array([bool(x) for x in qa])[:, None], 0.78 * titles + 0.22 * authors, titles)
    both = bounded.score_bounds((left, right), (bounded.Side(qa), bounded.Side(ca)))
    assert (scores <= both + 1e-3).all()


@pytest.fixture(scope="module")
def shelf(spark):
    """Three hundred titles over few words, so that a word is in a third of them, with repeats, nulls and accents."""
    rng = random.Random(11)
    names = ["Ann Smith", "Smithson, Bo", "Ünal Cé", None, "Li", ""]
    pool = texts(rng, 150, 6)
    data = [
        (i, i // 2, rng.choice([t, t.upper(), t.replace("e", "é"), None if i % 50 == 0 else t]), rng.choice(names), None, None,
         rng.choice([None, 5, 5, 9]), rng.choice([None, 1.0, 2.0]), rng.random() < 0.9)
        for i, t in enumerate(rng.choice(pool) for _ in range(300))
    ]
    wanted = [(i, edited(rng, t), rng.choice(names)) for i, t in enumerate(rng.choice(pool) for _ in range(60))]
    wanted += [(100, "of", None), (101, "", "Ann Smith"), (102, None, None), (103, "zebra", "li"), (104, "of the", "ann smith")]
    asked = spark.createDataFrame(wanted, "input_id int, title string, author string")
    return spark.createDataFrame(data, CATALOG), asked.withColumn("isbn", F.lit(None).cast("string"))


@pytest.mark.parametrize("first, blocks, threshold", [(1, (3, 5), 88.0), (50, (256, 2048), 60.0)])
def test_best_match_equals_scoring_all_pairs(shelf, monkeypatch, first, blocks, threshold):
    catalog, asked = shelf
    monkeypatch.setattr(bounded, "REQUEST_BLOCK", blocks[0])
    monkeypatch.setattr(bounded, "TITLE_BLOCK", blocks[1])
    requests = ops.match_requests(asked)
    every = ops.argmax_match(ops.score_candidates(ops.request_candidates(requests, catalog, 10_000), catalog), ["q_title", "q_author"])
    shown = lambda df: sorted((r.q_title, r.q_author, r.book_id, round(r.score, 9)) for r in df.collect())
    want = shown(every.where(F.col("score") >= threshold))
    assert len(want) > 20
    assert shown(ops.best_match(requests, catalog, threshold, first)) == want


def test_nothing_to_match(shelf):
    catalog, asked = shelf
    requests = ops.match_requests(asked)
    assert ops.best_match(requests.limit(0), catalog).count() == 0
    assert ops.best_match(requests, catalog.limit(0)).count() == 0


def test_unpopular_book_with_a_cut_title(spark):
    """Sixty more popular books share each word and the author; the right one is found without a limit, not with one."""
    rows = [(i, i, f"Common {w} story {i}", "Someone", 1000 - i, 1.0, True) for i in range(120) for w in ["tales"]]
    rows.append((999, 999, "Common garden tales of winter", "Someone", 1, 1.0, True))
    catalog = spark.createDataFrame(rows, "book_id bigint, work_id bigint, title string, primary_author string, ratings_count bigint, bayesian_rating double, is_canonical_edition boolean")
    catalog = catalog.withColumns({"isbn": F.lit(None).cast("string"), "isbn13": F.lit(None).cast("string")})
    asked = spark.createDataFrame([(1, "comon garden tales of wintr", "Someone", None)], "input_id int, title string, author string, isbn string")
    got = ops.local_match(asked, catalog, ["input_id"]).collect()
    assert [r.book_id for r in got] == [999] and got[0].score > 88
    assert 999 not in [r.book_id for r in ops.local_match(asked, catalog, ["input_id"], limit=60).collect()]
