import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from lectern.llm import simhash
from lectern.llm.components import connected_components


def print_of(text, shingle=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    parts = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] if len(words) >= shingle else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            up[n] = n = up[up[n]]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="module")
def copies(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(900)]
    rows, base = [], [[*rng.choices(words, k=rng.randint(60, 400))] for _ in range(40)]
    for i in range(400):
        text = list(base[i % 40] if i % 10 else base[0])
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((1000 - i, " ".join(text)))
    return rows


def expected(rows, radius=3):
    prints = [(d, print_of(t)) for d, t in rows]
    near = [(a, b) for i, (a, x) in enumerate(prints) for b, y in prints[:i] if (x ^ y).bit_count() <= radius]
    return dict(prints), groups([d for d, _ in rows], near)


@pytest.mark.parametrize("radius", [0, 3, 6])
@pytest.mark.parametrize("hot", [200_000, 6])
def test_components_like_all_pairs(spark, copies, radius, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    prints, component = expected(copies, radius)
    got = simhash.near_duplicates(spark.createDataFrame(copies, "doc_id bigint, text string"), radius=radius).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == component
    assert len(set(component.values())) < 390


def test_thresholds_add_up():
    rng = np.random.default_rng(3)
    bits = (rng.random((4000, 64)) < rng.random(64)).astype(float)
    bits[:, 9] = bits[:, 8]
    for n in (100, 4000, 10**8):
        for radius in (0, 1, 3, 8):
            parts = simhash.plan(n, bits.T @ bits * (n / 4000), radius)
            used = {b for g, _ in parts for b in g}
            assert sum(t + 1 for _, t in parts) == radius + 1 and sum(len(g) for g, _ in parts) == len(used)


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(4)
    bits = (rng.random((5000, 64)) < 0.5).astype(float)
    bits[:, 40:44] = bits[:, 3:7]
    single, pair = simhash._agreements(5000, bits.T @ bits)
    of = {b: i for i, g in enumerate(simhash.group_bits(single, pair, 4)) for b in g}
    assert all(of[a] == of[a + 37] for a in range(3, 7))


def test_big_buckets_and_small_ones_link_alike():
    rng = np.random.default_rng(6)
    words = rng.integers(0, 1 << 63, 30, dtype=np.uint64)[rng.integers(0, 30, 300)] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    for keys in (np.zeros(300, np.int64), np.sort(rng.integers(0, 40, 300))):
        pairs = simhash.bucket_links(keys, words[:, None], 2, 64)
        near = [(i, j) for i in range(300) for j in range(i) if keys[i] == keys[j] and int(words[i] ^ words[j]).bit_count() <= 2]
        ids = list(map(int, words))
        want = groups(set(ids), [(ids[i], ids[j]) for i, j in near])
        assert groups(set(ids), [tuple(map(int, p)) for p in pairs]) == want


def test_connected_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 50)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    edges += [(5, 5), (None, 7), (200, 201)]
    real = [(a, b) for a, b in edges if a is not None and a != b]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == groups({n for e in real for n in e}, real)
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def test_edges(edges, edge_rows):
    got = Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(edges).collect())
    prints = [print_of(r[1]) for r in edge_rows]
    part = groups(set(prints), [(a, b) for a in set(prints) for b in set(prints) if (a ^ b).bit_count() <= 3])
    least = {}
    for r, p in zip(edge_rows, prints):
        if r[0] is not None:
            least[part[p]] = min(r[0], least.get(part[p], r[0]))
    assert got == Counter((r[0], p, least.get(part[p])) for r, p in zip(edge_rows, prints))
    assert simhash.near_duplicates(edges.limit(0)).collect() == []
    stays = simhash.drop_near_duplicates(edges)
    assert stays.columns == edges.columns
    assert Counter(r.doc_id for r in stays.collect()) == Counter([1, 2, 4, 4, None, None, 6, 8, 9, 10])


def test_similar_texts_go_and_others_stay(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    rows, copies = [], []
    for i in range(150):
        text = rng.choices(words, k=300)
        rows.append((i, " ".join(text)))
        if i % 3 == 0:
            for at in rng.sample(range(300), 3):
                text[at] = rng.choice(words)
            rows.append((1000 + i, " ".join(text)))
            copies.append(1000 + i)
    left = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert left >= set(range(150)) and len(left & set(copies)) <= 2
