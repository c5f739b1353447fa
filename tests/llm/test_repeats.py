import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lectern.llm import repeats
from lectern.llm.suffixes import deep_shallow


def brute(rows, length):
    """Result of each different (id, text), in the documented order."""
    import xxhash

    def place(row):
        return (1 << 63 if row[0] is None else row[0], np.uint64(xxhash.xxh64_intdigest((row[1] or "").encode(), 42)).astype(np.int64))

    seen, out = set(), {}
    for row in sorted(set(rows), key=place):
        data = (row[1] or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            window = data[p:p + length]
            if window in seen:
                gone[p:p + length] = True
            seen.add(window)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out[row] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(df, **more):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.repeats(df, **more).collect())


def wanted(rows, length=100):
    found = brute(rows, length)
    return Counter((r[0], *found[r]) for r in rows)


@pytest.mark.parametrize("limit", [9, 40, 100])
@pytest.mark.parametrize("shallow", [0, 8, 32])
def test_deep_shallow_sorts(limit, shallow):
    rng = np.random.default_rng(limit + shallow)
    for letters in (1, 2, 4):
        data = rng.integers(97, 97 + letters, 1500).astype(np.uint8)
        data = np.concatenate([data, data[:700], data[30:500], np.zeros(8, np.uint8)])
        starts = np.arange(len(data) - 8 - limit + 1)
        rng.shuffle(starts)
        order, leaf = deep_shallow(data, starts, limit, shallow)
        strings = [data[s:s + limit].tobytes() for s in starts[order]]
        assert strings == sorted(strings)
        assert [a == b for a, b in zip(strings, strings[1:])] == [a == b for a, b in zip(leaf, leaf[1:])]


def test_segments_cover_each_window_once():
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 100, n).astype(np.uint8) for n in (0, 50, 99, 100, 101, 700, 3)]
    data, ends = np.concatenate(texts), np.cumsum([len(t) for t in texts])
    text, gram, _, first, n = repeats.segments(data, ends, 100, 28)
    windows = [(t, p) for t, f, k in zip(text, first, n) for p in range(f, f + k)]
    begin = np.append(0, ends)
    assert sorted(windows) == [(t, p) for t in range(len(texts)) for p in range(begin[t], ends[t] - 99)]
    by_content = {}
    for t, f, k, g in zip(text, first, n, gram):
        for p in range(f, f + k):
            assert by_content.setdefault(data[p:p + 100].tobytes(), g) == g


@pytest.mark.parametrize("hot", [4096, 2])
@pytest.mark.parametrize("length,gram", [(100, 28), (20, 6)])
def test_like_brute_force(spark, hot, length, gram):
    rng = random.Random(length)
    passage = "".join(rng.choices("abcdef é", k=170))
    rows = []
    for i in range(70):
        own = "".join(rng.choices("uvwxyz ", k=rng.randint(0, 160)))
        rows.append((i, own + passage[rng.randint(0, 9):] + own[:40] + ("ab" * 90 if i % 9 == 0 else "")))
    rows += [(200 + i, rows[3][1]) for i in range(20)] + [(300, "a" * 900), (301, "q" * 101)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert result(df, length=length, gram=gram, hot=hot) == wanted(rows, length)


def test_given_documents(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert result(sample) == wanted(rows)


def test_edges(edges, edge_rows):
    rows = [(r[0], r[1]) for r in edge_rows]
    assert result(edges) == wanted(rows)
    assert repeats.repeats(edges.limit(0)).collect() == []
    cut = repeats.remove_repeats(edges)
    assert cut.columns == edges.columns and cut.schema["text"].dataType == edges.schema["text"].dataType
    got = {(r.doc_id, r.text, r.n_chars) for r in cut.collect()}
    assert (7, "", 0) in got and (2, None, None) in got and (6, "é", 1) in got and (1, rows[0][1], len(rows[0][1])) in got


def test_whole_code_points():
    text = "aé€b".encode()
    assert repeats.cut_text(text, [(2, 5)]) == "aé€b".encode()
    assert repeats.cut_text(text, [(1, 6)]) == b"ab"
    assert repeats.cut_text(text, [(0, 2), (3, 7)]) == "é".encode()
