import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from lectern.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    marked = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    measures = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked))
    return (*measures, len(words) < 50 or 100 * len(marked) > 50 * len(words))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b#é \U0001f600", max_size=120)), max_size=6))
def test_base_measures(texts):
    m = quality.Measures(pa.array(texts, pa.string()))
    got = list(zip(m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed))
    assert [tuple(map(int, g)) for g in got] == [tuple(map(int, brute(t))) for t in texts]


def test_distance_is_a_distance():
    q = np.array([0.5, 0.25, 0.25])
    counts = np.array([[5000, 2500, 2500], [10_000, 0, 0], [0, 0, 10_000]])
    near, far, farther = quality.js_distance(counts, q)
    p = np.array([1.0, 0, 0])
    m = (p + q) / 2
    by_hand = np.sqrt((np.log2(1 / m[0]) + sum(x * np.log2(x / y) for x, y in zip(q, m))) / 2)
    assert near == 0 and abs(far - by_hand) < 1e-3 and far < farther < 1


def test_clean_texts_stay_and_junk_goes(spark, sample):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r.doc_id: (r.kept, r.base_failed) for r in quality.quality(docs).collect()}
    clean = [kept[d][0] for d, good in labels.items() if d in kept and good and not kept[d][1]]
    junk = [kept[d][0] for d, good in labels.items() if d in kept and not good]
    assert np.mean(clean) > 0.99 and np.mean(junk) < 0.05


def test_edges(edges, edge_rows):
    got = quality.quality(edges).collect()
    wanted = Counter((r[0], *brute(r[1])) for r in edge_rows)
    assert Counter(tuple(r)[:7] for r in got) == wanted
    assert not any(r.kept for r in got if r.base_failed)
    assert quality.quality(edges.limit(0)).collect() == []
    stays = quality.keep_good(edges)
    assert stays.columns == edges.columns
    assert Counter(r.doc_id for r in stays.collect()) == Counter(r.doc_id for r in got if r.kept)


def test_rare_languages_are_compared(spark):
    """Junk under a rare, misspelt or null language goes, clean text under it stays; a small language has its own reference."""
    rng = random.Random(3)
    english = [f"{a}{b}" for a in "the of and river stone house garden letter winter morning".split() for b in ("", "s", "ing", "ed")]
    small = [w[::-1] + "o" for w in english]
    say = lambda words, n=300: " ".join(rng.choice(words) for _ in range(n))
    junk = lambda: " ".join("".join(rng.choices("XQZ#$%&0123456789", k=7)) for _ in range(300))
    rows = [(i, say(english), "en") for i in range(400)] + [(1000 + i, say(small), "xs") for i in range(10)]
    rows += [(2000 + i, junk(), lang) for i, lang in enumerate(["zz", "enn", None, "xs"])] + [(3000 + i, say(english), lang) for i, lang in enumerate(["enn", None])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    rules = quality.Rules(least_share=0.2, least_words=2000)
    kept = {r.doc_id for r in quality.quality(docs, rules).collect() if r.kept}
    assert kept == {r[0] for r in rows if not 2000 <= r[0] < 3000}
    assert {r.doc_id for r in quality.keep_good(docs, rules).collect()} == kept
