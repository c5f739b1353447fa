import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from lectern.llm import periodic, queries


def brute(words, least_words=24, least_periods=3):
    """Runs by comparing every period at every place; the smallest period of a stretch is the first found."""
    found, n = {}, len(words)
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least_words, least_periods * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{a},{m},{q}\n" for a, m, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    own = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *own, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def random_texts(seed):
    """Texts over few words, with runs, runs in runs, neighbouring runs and near misses."""
    rng = random.Random(seed)
    for _ in range(150):
        letters = [f"w{i}" for i in range(rng.choice([1, 2, 3, 6, 200]))]
        words = []
        for _ in range(rng.randrange(6)):
            unit = rng.choices(letters, k=rng.randrange(1, 14))
            if rng.random() < 0.3:
                unit = unit * 3 + rng.choices(letters, k=rng.randrange(3))
            words += (unit * rng.randrange(1, 12))[:rng.randrange(1, 90)]
            words += rng.choices(letters, k=rng.randrange(4))
        yield words


@pytest.mark.parametrize("least", [(24, 3), (1, 2), (5, 2), (30, 4)])
def test_runs_like_brute_force(least):
    texts = list(random_texts(sum(least)))
    coded = [[w.encode() for w in t] for t in texts]
    assert periodic.batch_runs(coded, *least) == [brute(t, *least) for t in coded]


def test_long_runs_and_fibonacci_words():
    a, b = "x", "y"
    for _ in range(15):
        a, b = a + b, a
    texts = [[c.encode() for c in a], [b"same"] * 50_000, [b"p", b"q", b"r"] * 20_000 + [b"p", b"p"]]
    made = periodic.batch_runs(texts, 24, 3)
    assert made[0] == brute(texts[0])
    assert made[1:] == [[(0, 50_000, 1)], [(0, 60_001, 3)]]


def test_query_on_given_documents(spark, sample, tmp_path):
    rows = sorted(tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.001").collect())
    assert rows == sorted(expected(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect())
    assert sum(r[1] for r in rows) > 5


def test_edges(spark, edges, edge_rows):
    found = periodic.digests(periodic.periodic_runs(edges)).collect()
    want = []
    for i, text, *_ in edge_rows:
        words = (text or "").encode().split()
        runs = brute(words) if len(words) < 1000 else []
        want.append((str(i), len(runs)))
    assert sorted((str(r.doc_id), r.n_runs) for r in found) == sorted(want)
    by_id = {r.doc_id: r for r in found}
    assert (by_id[9].start, by_id[9].length, by_id[9].period, by_id[9].exponent_milli) == (0, 300, 1, 300_000)
    empty = hashlib.sha256(b"").hexdigest()
    assert (by_id[2].runs_sha256, by_id[2].collapsed_sha256, by_id[2].start) == (empty, empty, None)
    assert by_id[5].collapsed_sha256 == empty
    assert periodic.periodic_runs(edges.limit(0)).count() == 0


def test_collapsed_text(spark):
    text = "start here " + "one two three " * 9 + "one two end"
    row = periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row.collapsed == "start here one two three end" and [tuple(r) for r in row.runs] == [(2, 29, 3)]
    with pytest.raises(ValueError):
        periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), least_periods=1)
