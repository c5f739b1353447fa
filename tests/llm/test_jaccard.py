import random

import numpy as np

from lectern.llm import jaccard, simhash


def shingles(text):
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def exact(rows, limit=0.8):
    """Ids that are the smallest of their component, by all pairs."""
    sets = {d: shingles(t) for d, t in rows}
    up = {d: d for d in sets}

    def find(d):
        while up[d] != d:
            d = up[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= limit * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d for d in sets if find(d) == d}


def test_pairs_around_the_threshold(spark):
    """One run of new words at the end gives any similarity: below 0.8 both stay, from 0.8 on the copy goes."""
    rng, rows = random.Random(1), []
    for i in range(400):
        text = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        cut = 5 + i % 56
        rows += [(i, " ".join(text)), (1000 + i, " ".join(text[:-cut] + [f"x{rng.randrange(10**6)}" for _ in range(cut)]))]
    left = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert left == exact(rows)


def test_chains_and_groups_like_all_pairs(spark):
    """Copies of copies, whose ends are no near duplicates, and groups whose members aren't all near the smallest node."""
    rng, rows = random.Random(2), []
    for g in range(8):
        text = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        for i in range(40):
            if g % 2 == 0:
                text = list(text)
            else:
                text = list(text if i % 5 else text[::-1])
            at = rng.randrange(116)
            text[at:at + 3] = [f"y{rng.randrange(10**6)}" for _ in range(3)]
            rows.append((g * 100 + i, " ".join(text)))
    rng.shuffle(rows)
    left = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert left == exact(rows)


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    """Buckets cut into blocks give the same groups."""
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", 7)
    test_chains_and_groups_like_all_pairs(spark)


def test_bucket_links_join_what_is_similar():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[k * 2:180 + k], rng.integers(0, 1 << 63, 20, dtype=np.uint64)])) for k in range(25)]
    sets += [np.unique(rng.integers(0, 1 << 63, 150, dtype=np.uint64)) for _ in range(5)] + [np.zeros(0, np.uint64)]
    groups = np.arange(len(sets)) + 100
    groups[3] = groups[7]
    for parts in (np.zeros(len(sets), int), np.arange(len(sets)) % 2):
        links = jaccard.bucket_links(parts, groups, sets, 0.8)
        want = {(i, j) for i in range(len(sets)) for j in range(i) if jaccard.similar(sets[i], sets[j], 0.8)
                and (not parts.any() or parts[i] != parts[j])}
        assert set(links) <= want and len(links) < len(sets)

        def merged(pairs):
            up = {g: g for g in groups.tolist()}
            for i, j in pairs:
                a, b = up[groups[i]], up[groups[j]]
                up = {g: min(a, b) if u in (a, b) else u for g, u in up.items()}
            return up

        assert merged(links) == merged(want)


def test_band_keys_find_what_the_formula_says():
    rng = np.random.default_rng(3)
    for j in (0.5, 0.8):
        found = 0
        for _ in range(1000):
            x = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
            both = round(300 * j)
            a, b = np.sort(x[:both + (300 - both) // 2]), np.sort(np.append(x[:both], x[both + (300 - both) // 2:]))
            found += bool((jaccard.band_keys(a) == jaccard.band_keys(b)).any())
        assert abs(found / 1000 - (1 - (1 - j**jaccard.ROWS) ** jaccard.BANDS)) < 0.05


def test_fingerprints_make_candidates(spark, monkeypatch):
    """Without any MinHash key, copies whose fingerprints are within three bits are still found, and compared exactly."""
    rng, rows = random.Random(7), []
    for i in range(60):
        text = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        rows += [(i, " ".join(text)), (1000 + i, " ".join(text[:-1] + ["other"]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(jaccard, "minhash_keys", lambda nodes: nodes.select("node", "n", "fp0").toDF("node", "n", "key").limit(0))
    prints = {}
    for d, t in rows:
        prints[d] = simhash.majority(jaccard.shingle_set(t.encode(), 5))[0]
    near = {i for i in range(60) if (prints[i] ^ prints[1000 + i]).bit_count() <= jaccard.RADIUS}
    found = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert len(near) > 40 and all(found[1000 + i] == i for i in near)
    assert all(found[1000 + i] == 1000 + i for i in set(range(60)) - near)
