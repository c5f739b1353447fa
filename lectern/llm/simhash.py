"""Near duplicates by SimHash fingerprints, found with a generalised pigeonhole index.

The bits of a fingerprint are cut into partitions. Two fingerprints within ``radius`` bits of each other are within t_i bits
of each other on at least one partition i whenever the thresholds add up to radius - partitions + 1 (a threshold of -1 leaves
a partition out). Correlated bits share a partition, so that the others stay selective; a dynamic program spreads the
thresholds so that probes plus estimated candidates cost least. Both follow from the bit and bit-pair counts over all
fingerprints.

Documents with equal fingerprints are one node. In a bucket the links are walked breadth first, and only a spanning forest
leaves the task, never all pairs of a group. Buckets beyond ``HOT_BUCKET`` members are cut again by further partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import prepare, released, store, text_rows
from lectern.llm.components import connected_components

BITS = 64
#: Members of one bucket that one task walks; larger buckets are cut by further bits first.
HOT_BUCKET = 200_000
#: Buckets of up to so many members are compared by shifting the sorted rows.
SMALL_BUCKET = 24
#: Smaller inputs are planned as if they had so many fingerprints, so that probes a fingerprint don't jump as they grow.
PLANNED = 1 << 20
#: Cost of writing, moving and sorting one probe, in pairs compared.
PROBE_COST = 400.0


# ---------------------------------------------------------------- fingerprints


def _wider(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th further 64 bits of each hash (a finaliser over hash and k)."""
    if k == 0:
        return hashes
    x = hashes + np.uint64(0x9E3779B97F4A7C15 * k % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(tokens: list[bytes], shingle: int) -> np.ndarray:
    """The hash of each run of ``shingle`` words; fewer words are one run, none has no hash."""
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) < shingle:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        stops = np.cumsum(lengths + 1) - 1
        starts, ends = (stops - lengths)[:len(tokens) - shingle + 1].tolist(), stops[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts, ends)), dtype=np.uint64, count=len(starts))


def fingerprint(text: bytes, shingle: int = 3, words: int = 1) -> list[int]:
    """``words`` times 64 bits: a bit is 1 if more than half of the shingles' hashes have it."""
    return majority(shingle_hashes(text.lower().split(), shingle), words)


def majority(hashes: np.ndarray, words: int = 1) -> list[int]:
    """``words`` times 64 bits: a bit is 1 if more than half of the hashes have it; zero without any."""
    if not len(hashes):
        return [0] * words
    counts = np.zeros((words, BITS), dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        block = hashes[at:at + (1 << 15)]
        for k in range(words):
            bits = np.unpackbits(_wider(block, k).view(np.uint8), bitorder="little").reshape(-1, BITS)
            counts[k] += np.add.reduce(bits, axis=0, dtype=np.uint32)
    major = (2 * counts > len(hashes)).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<u8")[:, 0].tolist()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, words: int = 1) -> DataFrame:
    """(id, fp0 .. fp[words-1]) of every row; a null or empty text has the fingerprint zero."""
    prepare(docs.sparkSession)
    names = [f"fp{k}" for k in range(words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t, shingle, words) for t in text_rows(batch.column(1))], dtype=np.uint64).reshape(-1, words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(made[:, k].view(np.int64)) for k in range(words))], ["id", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(lambda batches: released(run(batches)), f"id {kind}, " + ", ".join(f"{n} bigint" for n in names))


# ---------------------------------------------------------------- the partitioning


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each pair of bits, how many have both set. 64 x 64 sums over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(values), 1 << 14):
                bits = np.unpackbits(values[at:at + (1 << 14)].view(np.uint8), bitorder="little").reshape(-1, BITS).astype(np.float32)
                total += bits.T @ bits
            n += len(values)
        cells = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], ["cell", "n"])

    sums = np.zeros(BITS * BITS + 1)
    for cell, n in nodes.select("fp0").mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n")).collect():
        sums[cell] = n
    return int(sums[-1]), sums[:-1].reshape(BITS, BITS)


def _agreements(n: int, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance that two fingerprints agree on a bit, and on a pair of bits."""
    one = both.diagonal() / n
    p11 = both / n
    p10, p01 = one[:, None] - p11, one[None, :] - p11
    p00 = 1 - p11 - p10 - p01
    return one**2 + (1 - one) ** 2, p11**2 + p10**2 + p01**2 + p00**2


def group_bits(single: np.ndarray, pair: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of nearly equal size: each takes, one bit at a time, the free bit most correlated with its own bits."""
    gain = np.log(np.maximum(pair, 1e-9) / np.maximum(np.outer(single, single), 1e-9))
    free, groups = set(range(len(single))), []
    for i in range(parts):
        size = len(free) // (parts - i)
        order = sorted(free)
        first = max(order, key=lambda b: (sum(gain[b, c] for c in order if c != b), -b))
        group = [first]
        free.discard(first)
        while len(group) < size:
            bit = max(sorted(free), key=lambda b: (sum(gain[b, g] for g in group), -b))
            group.append(bit)
            free.discard(bit)
        groups.append(sorted(group))
    return groups


def _estimate(group: list[int], single: np.ndarray, pair: np.ndarray, most: int) -> np.ndarray:
    """Chance that two fingerprints differ in at most 0, 1, ... most bits of a group (a tree of pairs corrects for correlation)."""
    spread = np.zeros(most + 1)
    spread[0] = 1.0
    for b in group:
        spread = single[b] * spread + (1 - single[b]) * np.append(0, spread[:-1])
    lift, joined = 0.0, {group[0]}
    for b in group[1:]:
        lift += max(0.0, max(math.log(max(pair[b, g], 1e-9) / (single[b] * single[g])) for g in joined))
        joined.add(b)
    return np.minimum(1.0, np.cumsum(spread) * math.exp(lift))


def plan(n: int, both: np.ndarray, radius: int) -> list[tuple[list[int], int]]:
    """Partitions and their thresholds, for the least estimated cost of probes and candidates."""
    if n < 2:
        single, pair = np.full(BITS, 0.5), np.full((BITS, BITS), 0.25)
    else:
        single, pair = _agreements(n, both)
    best: tuple[float, list[tuple[list[int], int]]] = (math.inf, [])
    for parts in range(1, min(radius + 1, 16) + 1):
        groups = group_bits(single, pair, parts)
        budget = radius - parts + 1
        # least[s]: cost and thresholds of the groups so far whose thresholds + 1 add up to s
        least: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            most = min(len(group), budget + parts)
            chance = _estimate(group, single, pair, most)
            grown: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, chosen) in least.items():
                for t in range(-1, most + 1):
                    probes = sum(math.comb(len(group), d) for d in range(t + 1))
                    if probes > 5000:
                        break
                    more = 0.0 if t < 0 else probes * n * PROBE_COST + chance[t] * n * n / 2
                    if spent + t + 1 <= budget + parts and (cost + more, t) < (grown.get(spent + t + 1, (math.inf, []))[0], 99):
                        grown[spent + t + 1] = (cost + more, [*chosen, t])
            least = grown
        if budget + parts in least and least[budget + parts][0] < best[0]:
            best = least[budget + parts][0], list(zip(groups, least[budget + parts][1]))
    return [(g, t) for g, t in best[1] if t >= 0]


# ---------------------------------------------------------------- probe and verify


def _mask(bits: list[int]) -> np.uint64:
    return np.uint64(sum(1 << b for b in bits))


def _flips(bits: list[int], threshold: int) -> np.ndarray:
    """All masks of up to ``threshold`` of the given bits."""
    from itertools import combinations

    return np.array([sum(1 << b for b in some) for d in range(threshold + 1) for some in combinations(bits, d)], dtype=np.uint64)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    return _wider(x ^ np.uint64(salt * 0x9E37 + 1), 1 + salt)


def probe(nodes: DataFrame, parts: list[tuple[list[int], int]], names: list[str]) -> DataFrame:
    """One row per node and probed value: (key, fp...). With a threshold over 0 the node also probes the values around its own."""
    chosen = [(int(_mask(g)), _flips(g, t)) for g, t in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                some = batch.slice(at, 2000)
                values = some.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                for i, (mask, flips) in enumerate(chosen):
                    keys = _mix((values & np.uint64(mask))[:, None] ^ flips[None, :], i)
                    take = pa.array(np.repeat(np.arange(len(values)), len(flips)))
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), *(c.take(take) for c in some.columns)], ["key", *names])

    return nodes.select(*names).mapInArrow(run, "key bigint, " + ", ".join(f"{n} bigint" for n in names))


def _near(a: np.ndarray, b: np.ndarray, radius: int, wide: int) -> np.ndarray:
    """Which rows are within the radius on the first word, and within ``wide`` bits over all words."""
    near = np.bitwise_count(a[..., 0] ^ b[..., 0]) <= radius
    if a.shape[-1] > 1:
        near &= np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64) <= wide
    return near


def bucket_links(keys: np.ndarray, rows: np.ndarray, radius: int, wide: int) -> np.ndarray:
    """Links that join, within each run of equal keys, what is near to each other. keys are sorted; result: pairs of first words."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    size_of = np.repeat(sizes, sizes)
    found = []
    small = np.flatnonzero(size_of <= SMALL_BUCKET)
    for shift in range(1, min(SMALL_BUCKET, int(sizes.max(initial=1)))):
        at = small[small + shift < len(keys)]
        at = at[keys[at] == keys[at + shift]]
        at = at[_near(rows[at], rows[at + shift], radius, wide)]
        found.append(np.stack([rows[at, 0], rows[at + shift, 0]], axis=1))
    word = np.ascontiguousarray(rows[:, 0])
    for start, size in zip(starts[sizes > SMALL_BUCKET], sizes[sizes > SMALL_BUCKET]):
        left = np.arange(start, start + size)
        near_word = word[left]
        while len(left) > 1:
            root, queue, left, near_word = left[0], [left[0]], left[1:], near_word[1:]
            while queue and len(left):
                at = queue.pop()
                met = np.flatnonzero(np.bitwise_count(near_word ^ word[at]) <= radius)
                if len(met):
                    met = met[_near(rows[left[met]], rows[at], radius, wide)]
                if len(met):
                    found.append(np.stack([near_word[met], np.full(len(met), word[root])], axis=1))
                    queue.extend(left[met])
                    keep = np.ones(len(left), bool)
                    keep[met] = False
                    left, near_word = left[keep], near_word[keep]
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    return pairs[pairs[:, 0] != pairs[:, 1]]


def _refine(probes: DataFrame, names: list[str], radius: int, level: int) -> DataFrame:
    """Rows of hot keys under finer keys: of radius + 1 parts of the bits, near rows agree on one."""
    order = [(b * (2 * level + 5)) % BITS for b in range(BITS)]
    parts = [sorted(order[i::radius + 1]) for i in range(radius + 1)]
    finer = [F.xxhash64(F.lit(level), F.lit(i), "key", F.col("fp0").bitwiseAND(F.lit(int(np.array(_mask(p)).view(np.int64)[()]))))
             for i, p in enumerate(parts)]
    return probes.select(F.explode(F.array(*finer)).alias("key"), *names)


def links(nodes: DataFrame, radius: int = 3, wide: int | None = None) -> DataFrame:
    """Links (u, v) between fingerprints (first words) that join every two within the radius; a spanning forest per bucket.

    nodes: distinct rows fp0, fp1, ... With more than one word, links also need at most ``wide`` differing bits over all words.
    """
    names = nodes.columns
    n, both = bit_statistics(nodes)
    most = max(n, PLANNED)
    probes = probe(nodes, plan(most, both * (most / max(n, 1)), radius), names)
    limit = wide if wide is not None else BITS * len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows = np.zeros(0, np.int64), np.zeros((0, len(names)), np.uint64)

        def out(k: np.ndarray, r: np.ndarray) -> pa.RecordBatch:
            pairs = np.unique(bucket_links(k, r, radius, limit), axis=0).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["u", "v"])

        for batch in batches:
            keys = np.append(keys, batch.column(0).to_numpy(zero_copy_only=False))
            more = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1).astype(np.int64).view(np.uint64)
            rows = np.concatenate([rows, more])
            if len(keys) and keys[0] != keys[-1]:
                cut = int(np.searchsorted(keys, keys[-1]))
                yield out(keys[:cut], rows[:cut])
                keys, rows = keys[cut:], rows[cut:]
        if len(keys):
            yield out(keys, rows)

    found, level = None, 0
    while True:
        hot = None
        if n > HOT_BUCKET and level < 4:
            probes = store(probes, "probes")
            counts = store(probes.groupBy("key").count().where(F.col("count") > HOT_BUCKET).select("key"), "hot")
            hot = None if counts.isEmpty() else counts
        cold = probes if hot is None else probes.join(hot, "key", "left_anti")
        made = cold.repartition("key").sortWithinPartitions("key").mapInArrow(lambda batches: released(run(batches)), "u bigint, v bigint")
        found = made if found is None else found.unionByName(made)
        if hot is None:
            return found
        level += 1
        probes = _refine(probes.join(hot, "key", "left_semi"), names, radius, level)


def components(prints: DataFrame, words: int, radius: int, wide: int | None) -> DataFrame:
    """(fp..., first): for each distinct fingerprint the smallest id of its component."""
    names = [f"fp{k}" for k in range(words)]
    nodes = store(prints.groupBy(*names).agg(F.min("id").alias("least")), "nodes")
    labels = connected_components(links(nodes.select(*names), radius, wide))
    placed = nodes.join(labels, F.col("fp0") == F.col("node"), "left").withColumn("component", F.coalesce("component", "fp0"))
    placed = store(placed.select(*names, "component", "least"), "placed")
    first = placed.groupBy("component").agg(F.min("least").alias("first"))
    return placed.join(first, "component").select(*names, "first")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
    words: int = 1, similarity: float | None = None,
) -> DataFrame:
    """(id, fingerprint, component_id) of every row; component_id is the smallest id reachable over links of at most
    ``radius`` bits, the row itself included.

    With ``words`` over 1 and a ``similarity`` (Jaccard, of shingles), candidates within the radius on the first 64 bits are
    verified on all words: two sets of similarity J have the cosine 2J / (1 + J), and bits differ at its angle over pi. The
    limit is one standard deviation above that share, so that pairs at the similarity itself mostly pass.

    Nulls: a null text is empty; empty texts share the fingerprint zero and are linked like any other; a row with a null id
    takes part, but is never the smallest id unless all ids of its component are null (component_id is then null). Repeated
    rows come out as often as they came in. Only the two columns are read, so others may have any name.
    """
    wide = None
    if similarity is not None:
        share, bits = math.acos(2 * similarity / (1 + similarity)) / math.pi, BITS * words
        wide = round(bits * share + math.sqrt(bits * share * (1 - share)))
    prints = store(fingerprints(docs, id_col, text_col, shingle, words), "prints")
    names = [f"fp{k}" for k in range(words)]
    found = components(prints, words, radius, wide)
    return prints.join(found, names, "left").select(
        F.col("id").alias(id_col),
        F.concat(*(F.lower(F.lpad(F.hex(n), 16, "0")) for n in names)).alias("fingerprint"),
        F.col("first").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8,
) -> DataFrame:
    """The rows whose id is the smallest of their component (of repeated rows with that id, all), with all columns.

    Links are pairs whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, compared exactly (``jaccard``);
    fingerprints within three bits and MinHash keys say what is compared. Rows with a null id stay; a null text is empty, and empty texts are equal. An empty table gives no
    rows.
    """
    from lectern.llm import jaccard

    found = store(jaccard.near_duplicates(docs, id_col, text_col, shingle, similarity)
                  .where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__gone")).distinct(), "gone")
    return docs.join(found, F.col(id_col) == F.col("__gone"), "left_anti")
