import math
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.functions import fuzzy, scoring, text, vectors


def one(df):
    return df.first()[0]


def test_rating_tables(spark):
    pairs = [(r, read) for r in range(6) for read in (0, 1)]
    df = spark.createDataFrame(pairs, "rating int, is_read int")
    got = df.select("rating", "is_read", scoring.interaction_weight(), scoring.preference_signal()).collect()
    weight = {5: 1.0, 4: 0.8, 3: 0.5, 2: 0.2, 1: 0.1}
    signal = {5: 1.0, 4: 0.65, 3: 0.1, 2: -0.5, 1: -1.0}
    for rating, read, w, s in got:
        assert w == pytest.approx(weight.get(rating, 0.35 if read else 0.0))
        assert s == pytest.approx(signal.get(rating, 0.0))


def test_library_weight(spark):
    cases = [
        (5.0, "read", 1, 1.0), (5.0, "read", 8, 1.25), (4.5, "read", 2, 0.85), (3.0, "to-read", 0, 0.45),
        (2.0, "read", 9, -0.45), (1.0, "read", 1, -1.0), (0.0, "Currently-Reading", 1, 0.30), (0.0, "read", 3, 0.35),
        (None, "to-read", None, 0.0),
    ]
    df = spark.createDataFrame(cases, "my_rating double, exclusive_shelf string, read_count int, want double")
    for want, got in df.select("want", scoring.library_preference_weight()).collect():
        assert got == pytest.approx(want)


def test_scores(spark):
    df = spark.createDataFrame(
        [(4.0, 10), (None, 10), (4.0, None), (4.0, 0)], "r double, n long"
    )
    bayes = [r[0] for r in df.select(scoring.bayesian_rating("r", "n", 3.0, 10.0)).collect()]
    assert bayes[0] == pytest.approx(3.5) and bayes[1] is None and bayes[2] is None and bayes[3] == pytest.approx(3.0)
    wilson = [r[0] for r in df.select(scoring.wilson_lower_bound("r", "n")).collect()]
    z, p, n = 1.959963984540054, 0.8, 10
    want = (p + z * z / (2 * n) - z * math.sqrt((p * (1 - p) + z * z / (4 * n)) / n)) / (1 + z * z / n)
    assert wilson[0] == pytest.approx(want) and wilson[1:] == [None, None, None]
    novelty = [r[0] for r in df.select(scoring.novelty_score("n")).collect()]
    assert novelty == pytest.approx([1 / math.log(10 + math.e)] * 2 + [1.0, 1.0])
    with pytest.raises(ValueError):
        scoring.z_score(0.5)
    with pytest.raises(ValueError):
        scoring.hybrid_score({}, {"collaborative": 0.5})
    with pytest.raises(ValueError):
        scoring.shares({"a": -1.0, "b": 2.0})


def test_minmax_without_spread(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, None), (3, 1.0), (3, 3.0), (3, None)], "u int, x double")
    got = df.select("u", scoring.minmax_scale("x", ["u"])).collect()
    assert sorted((u, -1 if v is None else v) for u, v in got) == [(1, 0), (1, 0), (2, 0), (3, -1), (3, 0), (3, 1)]


def test_recency(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-03-01",), (None,)], "d string").select(F.to_date("d").alias("d"))
    got = [r[0] for r in df.select(scoring.recency_decay("d", "2024-01-31", 30.0)).collect()]
    assert got == pytest.approx([0.5, 1.0, 1.0])
    assert one(df.select(scoring.recency_decay("d", "2024-01-31"))) == 1.0


def test_tokenize(spark):
    shown = "Sci-Fi & A b crème language_en-us decade_1990 -x- don't"
    df = spark.createDataFrame([(shown,), (None,)], "t string")
    tokens, empty = [r[0] for r in df.select(text.tokenize("t")).collect()]
    assert [t for t in tokens if len(t) > 1] == ["sci-fi", "creme", "language_en-us", "decade_1990", "don"]
    assert empty == []
    grams = one(df.select(text.ngrams(F.lit(["a1", "b2", "c3"]))))
    assert grams == ["a1", "b2", "c3", "a1 b2", "b2 c3"]
    assert one(df.select(text.ngrams(F.lit(["a1"])))) == ["a1"]
    assert one(df.select(text.ngrams(F.lit(["a1", "b2"]), 1))) == ["a1", "b2"]


@pytest.mark.parametrize("value", ["L'Étranger — Ünïcödé", "STRASSE Straße ﬁne №5", "Ǆ ñandú", "日本語 x", "", None, "a  b\tc"])
def test_normalize_text(spark, value):
    plain = "".join(c for c in unicodedata.normalize("NFKD", value or "") if not unicodedata.combining(c)).casefold()
    want = " ".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in plain).split())
    assert one(spark.createDataFrame([(value,)], "t string").select(text.normalize_text("t"))) == want


def test_identifiers_and_numbers(spark):
    df = spark.createDataFrame([('="014-044x"', "12.9", "1999", "2020/05/06", "true")], "i string, n string, y string, d string, b string")
    row = df.select(
        text.normalize_isbn("i"), text.safe_int("n"), text.safe_float("n"), text.parse_year("y"), text.lenient_date("d"),
        text.lenient_boolean("b"), text.title_key(F.lit(None).cast("string"), F.lit(" The  Cat's-Hat ")),
    ).first()
    assert row[:4] == ("014044X", 12, 12.9, 1999) and str(row[4]) == "2020-05-06" and row[5] and row[6] == "the cat s hat"
    bad = spark.createDataFrame([("x", "", "12th", "May 5", "maybe")], "i string, n string, y string, d string, b string")
    assert tuple(bad.select(text.safe_int("n"), text.safe_float("n"), text.parse_year("y"), text.lenient_date("d"), text.lenient_boolean("b")).first()) == (None,) * 5


def test_shared_value(spark):
    df = spark.createDataFrame([(" Ann ", "ANN"), ("", ""), (None, None), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(text.shared_value("x", "y")).collect()] == [True, False, False, False]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,), ([float("inf"), 1.0],)], "v array<double>").coalesce(1)
    got = [r[0] for r in df.select(vectors.l2_normalize("v")).collect()]
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1:] == [None, None, None]
    assert one(df.select(vectors.l2_norm("v"))) == 5.0
    pair = spark.createDataFrame([([2.0, 0.0], [0.0, 5.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0])], "a array<double>, b array<double>")
    joined = [r[0] for r in pair.coalesce(1).select(vectors.concat_scaled("a", 0.6, "b", 0.8)).collect()]
    assert joined[0] == pytest.approx([0.6, 0, 0, 0.8]) and joined[1] == pytest.approx([0, 0, 1, 0]) and joined[2] is None
    assert one(pair.limit(1).select(vectors.dot("a", "a"))) == 4.0


def test_fuzzy_definitions():
    assert fuzzy.ratio("this is a test", "this is a test!") == pytest.approx(96.5517, abs=1e-3)
    assert fuzzy.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100.0
    assert fuzzy.token_set_ratio("", "a") == 0.0
    assert fuzzy.partial_ratio("this is a test", "this is a test!") == 100.0
    assert fuzzy.weighted_ratio("", "x") == 0.0
    assert fuzzy.weighted_ratio("the old man", "the old man") == 100.0
    # length ratio above 1.5: partial scores count at 0.9
    assert fuzzy.weighted_ratio("dune", "dune messiah saga") == pytest.approx(90.0)
    assert fuzzy.weighted_ratio("ab", "ab" * 40) >= fuzzy.ratio("ab", "ab" * 40)


def test_lcs_against_table():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = ("".join(rng.choice(list("abc "), rng.integers(0, 12))) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert fuzzy._lcs(a, b) == table[-1, -1]


def test_dates_with_times(spark):
    from lectern.functions.text import lenient_date

    shown = ["2020-01-05 10:00:00", "2020-01-05T10:00Z", "2020/01/05", "2020-1-5", "1/5/2020 9:30 PM", "2020-01-05T10:00:00.5+02:00", " 2020-01-05 ",
             "2020-13-05", "someday", "2020-01-05 soon", "", None]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(shown)], "i int, s string").orderBy("i")
    got = [str(r[0]) for r in rows.select(lenient_date("s")).collect()]
    assert got == ["2020-01-05"] * 7 + ["None"] * 5
