"""Near duplicates by the exact Jaccard similarity of shingle sets, with candidates from SimHash fingerprints and banded MinHash.

A document is its set of shingle hashes (64 bits); equal sets are one node. Sets whose fingerprints are joined by steps of up to
``RADIUS`` bits (probed and verified by ``simhash``) have a key in common, and so are candidates. At a similarity of 0.8
fingerprints differ in about ten bits, more than probes can reach, so there are keys for the rest as well: ``BANDS`` keys of ``ROWS`` minima each make the
candidates: a pair of similarity J shares a key with the chance 1 - (1 - J**ROWS)**BANDS, 0.99997 at 0.8, and every document
has as many keys whatever the size of the corpus. No pair is linked before its two sets were compared.

A bucket's links are found without its pairs. First each member is compared with the bucket's hub, the member with the most
neighbours in all its buckets; what that links is a component. Only buckets that still hold several components go on, one of
those with the same members. There a task has the sets of a bucket, counts by postings what each member shares with all others,
and hands on the links that join components: fewer than there are members. Buckets of many members or large sets are cut into
blocks, and each two blocks meet in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import forget, prepare, released, store, text_rows
from lectern.llm.components import connected_components
from lectern.llm.simhash import links as fingerprint_links, majority, shingle_hashes

BANDS, ROWS = 20, 4
#: Bits that fingerprints of candidates may differ in.
RADIUS = 3
#: Shingles hashed at a time for the minima.
BLOCK = 1 << 12
#: Members and bytes of sets of a block of a bucket.
BLOCK_MEMBERS, BLOCK_BYTES = 2048, 16 << 20
#: Bytes of sets for each task that walks buckets, and members of a bucket that are compared pair by pair.
WALK_PART, FEW = 8 << 20, 4
_ODD = np.random.default_rng(42).integers(0, 1 << 63, (2, BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(text.lower().split(), shingle))


def band_keys(members: np.ndarray) -> np.ndarray:
    """One key for each band, from the minima of its hash functions over the set. Empty sets have the same keys."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(members), BLOCK):
        x = members[None, at:at + BLOCK] * _ODD[0]
        x ^= x >> np.uint64(32)
        x *= _ODD[1]
        least = np.minimum(least, x.min(axis=1))
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, ROWS))], dtype=np.uint64)


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sets (sorted, without repeats) is at least the given one. Empty sets are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def _prints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, row, node, n, keys, fp0) of every row; row is a hash of the text, node a 64-bit digest of its set, fp0 the set's
    fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, shingle) for t in text_rows(batch.column(1))]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64).view(np.int64)
            keys = pa.array([band_keys(s).view(np.int64) for s in sets], pa.list_(pa.int64()))
            marks = np.array([majority(s)[0] for s in sets], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(nodes), pa.array([len(s) for s in sets], pa.int64()), keys, pa.array(marks)],
                ["id", "row", "node", "n", "keys", "fp0"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _rows(docs, text_col, F.col(id_col).alias("id")).mapInArrow(
        lambda batches: released(run(batches)), f"id {kind}, row bigint, node bigint, n bigint, keys array<bigint>, fp0 bigint")


def _rows(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(*more, text.alias("text"), F.xxhash64(text).alias("row"))


def bucket_links(parts: np.ndarray, groups: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Pairs of members whose sets are similar, at most one for each two components that come together. ``groups`` has the
    component of each member; members of different ``parts`` are compared, or all if there is one part."""
    up = {g: g for g in groups.tolist()}

    def find(g: int) -> int:
        while up[g] != g:
            up[g] = up[up[g]]
            g = up[g]
        return g

    found: list[tuple[int, int]] = []

    def meet(i: int, j: int) -> None:
        a, b = find(int(groups[i])), find(int(groups[j]))
        if a != b:
            up[max(a, b)] = min(a, b)
            found.append((i, j))

    several = bool((parts != parts[0]).any())
    if len(sets) <= FEW:
        for i in range(len(sets)):
            for j in range(i):
                if find(int(groups[i])) != find(int(groups[j])) and not (several and parts[i] == parts[j]) and similar(sets[i], sets[j], similarity):
                    meet(i, j)
        return found
    size = np.array([len(s) for s in sets])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(token, kind="stable")
    held, first = owner[order], np.append(0, np.cumsum(np.bincount(token)))
    begin = np.append(0, np.cumsum(size))
    for i in range(len(sets)):
        own = token[begin[i]:begin[i + 1]]
        if not len(own):  # empty sets are equal, and one node
            continue
        n = first[own + 1] - first[own]
        members = held[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[own], n)]
        both = np.bincount(members, minlength=len(sets))[:i]
        near = both >= similarity * (size[i] + size[:i] - both) - 1e-9
        if several:
            near &= parts[:i] != parts[i]
        for j in np.flatnonzero(near).tolist():
            meet(i, j)
    return found


def _blocks(rows: DataFrame, key: str) -> DataFrame:
    """The rows with the number of blocks that their group needs, and their own block."""
    sizes = rows.groupBy(key).agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_MEMBERS, F.sum("n") * 8 / BLOCK_BYTES, F.lit(1))).cast("int").alias("blocks"))
    return rows.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def star_walks(stars: DataFrame) -> DataFrame:
    """Each head (head, n_head) with its members (node, n), by blocks of members: (walk, part, component, node, n)."""
    dealt = _blocks(stars, "head").withColumn("walk", F.xxhash64(F.lit("star"), "head", "block"))
    heads = dealt.select("walk", F.lit(0).alias("part"), F.col("head").alias("component"), F.col("head").alias("node"), F.col("n_head").alias("n"))
    return dealt.select("walk", F.lit(1).alias("part"), F.col("node").alias("component"), "node", "n").unionByName(heads.distinct())


def bucket_walks(rest: DataFrame) -> DataFrame:
    """Each two blocks of each bucket of (key, node, n, component): (walk, part, component, node, n)."""
    dealt = _blocks(rest, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    return dealt.select(pair.alias("walk"), F.col("block").alias("part"), "component", "node", "n")


def _walked(walks: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links (u, v) between the components of the members of each walk."""
    walks = store(walks, "walks")
    held = walks.agg(F.sum("n")).first()[0] or 0
    rows = walks.join(texts, "node").select("walk", "part", "component", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, parts, groups, sets = None, [], [], []

        def out() -> pa.RecordBatch:
            pairs = bucket_links(np.array(parts), np.array(groups), sets, similarity) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([groups[i] for i, _ in pairs], pa.int64()), pa.array([groups[j] for _, j in pairs], pa.int64())], ["u", "v"])

        for batch in batches:
            columns = (c.to_pylist() for c in batch.columns[:3])
            for w, part, group, text in zip(*columns, text_rows(batch.column(4))):
                if w != walk:
                    yield out()
                    walk, parts, groups, sets = w, [], [], []
                parts.append(part)
                groups.append(group)
                sets.append(shingle_set(text, shingle))
        yield out()

    dealt = rows.repartition(max(12, held * 8 // WALK_PART), "walk").sortWithinPartitions("walk")
    links = store(dealt.mapInArrow(lambda batches: released(run(batches)), "u bigint, v bigint"), "links")
    forget(walks.sparkSession, walks)
    return links


def _texts(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """(node, text) of the wanted (node, row): the texts are read again, so that only those of candidates are ever stored."""
    found = _rows(docs, text_col).join(wanted, "row")
    return store(found.groupBy("node").agg(F.first("text").alias("text")), "texts")


def minhash_keys(nodes: DataFrame) -> DataFrame:
    """(node, n, key) with a key for each band."""
    return nodes.select("node", "n", F.explode("keys").alias("key"))


def fingerprint_keys(nodes: DataFrame, similarity: float) -> DataFrame:
    """(node, n, key), the key of the fingerprint's component: fingerprints joined by steps of up to ``RADIUS`` bits share it.

    A set of n members has at most n / (n + 1) in common with another; sets too small for the similarity need no key.
    """
    nodes = nodes.where(F.col("n") * (1 - similarity) >= similarity - 1e-6)
    marks = store(nodes.select("fp0").distinct(), "marks")
    labels = connected_components(fingerprint_links(marks, RADIUS)).withColumnRenamed("node", "fp0")
    group = F.xxhash64(F.lit("fingerprint"), F.coalesce("component", "fp0"))
    return nodes.join(labels, "fp0", "left").select("node", "n", group.alias("key"))


def components(prints: DataFrame, docs: DataFrame, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """(node, first): for each node of ``prints`` the smallest id of its component; docs has the texts."""
    spark = prints.sparkSession
    nodes = store(prints.groupBy("node").agg(
        F.min("id").alias("least"), F.min("row").alias("row"), F.first("n").alias("n"), F.first("keys").alias("keys"),
        F.first("fp0").alias("fp0")), "nodes")
    probes = store(fingerprint_keys(nodes, similarity).unionByName(minhash_keys(nodes)), "probes")
    sizes = probes.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = store(probes.join(sizes, "key").select("key", "node", "n", "size"), "members")
    forget(spark, probes)
    weight = store(members.groupBy("node").agg(F.sum("size").alias("weight")).join(nodes.select("node", "row"), "node"), "weights")
    texts = _texts(docs, text_col, weight.select("node", "row"))
    heads = members.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node", "n")).alias("head"))
    # sets whose sizes differ by more can't be similar
    fits = F.least("n", "head.n") >= similarity * F.greatest("n", "head.n") - 1e-9
    stars = members.join(heads, "key").where((F.col("node") != F.col("head.node")) & fits)
    stars = stars.select(F.col("head.node").alias("head"), F.col("head.n").alias("n_head"), "node", "n").distinct()
    links = _walked(star_walks(stars), texts, shingle, similarity)
    labels = connected_components(links)
    placed = store(members.join(labels, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component")), "members")
    forget(spark, members, weight)
    seen = placed.groupBy("key").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("size"),
        F.expr("bit_xor(xxhash64(node))").alias("x"), F.expr("bit_xor(xxhash64(1, node))").alias("y")).where("a <> b")
    rest = store(placed.join(seen.groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key"), "key", "left_semi"), "rest")
    forget(spark, placed)
    more = _walked(bucket_walks(rest), texts, shingle, similarity)
    forget(spark, rest, texts)
    joined = connected_components(more).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    found = nodes.select("node", "least").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    found = found.join(joined, "component", "left").select("node", "least", F.coalesce("whole", "component").alias("component"))
    found = store(found, "placed")
    forget(spark, nodes, links, more)
    first = found.groupBy("component").agg(F.min("least").alias("first"))
    return found.join(first, "component").select("node", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, component_id) of every row; component_id is the smallest id reachable over pairs whose sets of ``shingle``-word
    shingles have at least this Jaccard similarity, the row itself included.

    Nulls: a null text is empty; empty texts are equal; a text of fewer words is one shingle; a row with a null id takes part,
    but is never the smallest id unless all ids of its component are null (component_id is then null). Repeated rows come out
    as often as they came in. An empty table gives no rows. Only the two columns are read.
    """
    prepare(docs.sparkSession)
    prints = store(_prints(docs, id_col, text_col, shingle), "prints")
    found = components(prints, docs, text_col, shingle, similarity)
    return prints.select("id", "node").join(found, "node", "left").select(F.col("id").alias(id_col), F.col("first").alias("component_id"))
