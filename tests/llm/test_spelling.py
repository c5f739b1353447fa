import random
import re
import zlib
from collections import Counter

import pytest

from lectern.llm import queries, spelling


def edits(word, alphabet):
    """All words one edit from a word, itself left out."""
    found = {word[:i] + word[i + 1:] for i in range(len(word))}
    found |= {word[:i] + c + word[j:] for i in range(len(word) + 1) for j in (i, i + 1) if j <= len(word) for c in alphabet}
    return found - {word}


def brute(rows, slips=None, least_chars=5, least_count=3):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if slips and h % slips == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}
    alphabet = sorted(set("".join(words)))
    near = {w: [x for x in edits(w, alphabet) if x in words] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], words.get(form[w]), root))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in df.collect())


def test_dense_words_like_brute_force(spark):
    """Short words over few letters, so that most have many neighbours, long chains of forms and ties."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        words = ["".join(rng.choices("abcé", k=rng.choice([4, 5, 5, 6, 7]))) for _ in range(400)]
        rows.append((i, " ".join(words) + " Straße straße STRASSE"))
    base = "immeasurably"
    for k in range(6):  # a chain: each form twice as frequent as the next
        rows.append((100 + k, " ".join([base[:12 - k]] * (3 * 2 ** (5 - k)))))
    rows.append((None, "nulls nulls nulls null nulll nulll nulll " + "x" * 5000))
    rows += [(200, "aaaaaa\nAAAAAA aaaaaa aaaaaaa-aaaaaaa,aaaaaaa"), (201, None), (202, ""), (202, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert rows_of(spelling.variants(docs)) == brute(rows)
    assert rows_of(spelling.variants(docs, slips=7)) == brute(rows, 7)
    chain = {r[0]: r for r in brute(rows)}
    assert chain[base[:7]][5] == base and chain[base[:7]][3] == base[:8]


def test_query_on_given_documents(spark, sample):
    rows = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    assert rows_of(queries.QUERIES["op11_spelling_variants"](spark, "/root/testdata/sf0.001")) == brute(rows, 97)


def test_edges(spark, edges, edge_rows):
    assert rows_of(spelling.variants(edges)) == brute([r[:2] for r in edge_rows])
    assert spelling.variants(edges.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(edges, ratio=1)


def test_signatures_meet_for_every_edit(spark):
    """Every single edit of a word, at any place, is found; of other pairs none."""
    words = {"anagrams"} | edits("anagrams", "aegmz") | {"gramsana", "smargana"}
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    found = {(r.word, r.near) for r in spelling.near_words(table).collect()}
    assert found == {(w, x) for w in words for x in edits(w, "abcdefghijklmnopqrstuvwxyz") & words}
