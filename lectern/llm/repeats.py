"""Removal of repeated passages: each byte covered by a string of ``length`` bytes that also starts earlier in the corpus.

Sorting every suffix of a corpus would move a hundred times its size, so the sort sees only what can repeat:

1. Every window of ``length`` bytes gets an anchor, the leftmost of its ``gram``-byte strings with the least hash. Windows in a
   row with the same anchor make a segment. Equal windows have equal anchors at the same place. Records of 32 bytes
   (anchor hash, segment hash, place) are dealt by anchor hash; of equal segments only the first of each task is dealt.
2. An anchor hash seen once can't repeat. Of equal segments all but the first are removed whole. Only different segments with the
   same anchor go on, with their bytes.
3. All suffixes at the windows of these segments are sorted by deep-shallow sorting. In each leaf the first stays.

Anchors of very many different segments (a passage in a large part of the corpus) are dealt again by the windows themselves.
A document's place in the corpus is its id, then the hash of its text; rows with both equal count as one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from lectern.llm.common import prepare, released, store, text_bytes, text_rows
from lectern.llm.suffixes import WORD, deep_shallow

#: Bytes hashed at once, and records that a task holds before it deals them.
SECTION, HELD = 1 << 18, 1 << 18
#: Bytes of text for each part of the first and of the other shuffles.
ANCHOR_PART, TEXT_PART = 16 << 20, 24 << 20
#: Different segments of one anchor beyond which its windows are dealt by themselves.
HOT_ANCHOR = 4_096
#: Bytes of segments that are sorted at once, where an anchor ends.
SORT_BYTES = 1 << 20

#: Place in the corpus (document, text hash), anchor and segment hash, first window and number of windows.
RECORD = np.dtype([("gram", "<u8"), ("segment", "<u8"), ("doc", "<i8"), ("hash", "<i8"), ("at", "<i8"), ("n", "<i4")])
_ID, _HASH, _SPANS = "__lectern_doc", "__lectern_hash", "__lectern_spans"


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte; powers of an odd base and of its inverse, modulo 2^64."""
    table = _finish(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    base = 0xD1342543DE82EF95
    ups = np.full(size, np.uint64(base))
    downs = np.full(size, np.uint64(pow(base, -1, 1 << 64)))
    ups[0] = downs[0] = 1
    return table, np.multiply.accumulate(ups), np.multiply.accumulate(downs)


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each p the first place of the least value in [p, p + width)."""
    place, span = np.arange(len(values), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        left_v, right_v = values[:-step], values[step:]
        left = left_v <= right_v
        values, place, span = np.where(left, left_v, right_v), np.where(left, place[:-step], place[step:]), span + step
    return place


def segments(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, gram hash, segment hash, first window, windows) of the texts that end at ``ends`` in data; places are in data."""
    found = []
    for start in range(0, max(0, len(data) - length + 1), SECTION):
        part = data[start:start + SECTION + length - 1]
        table, ups, downs = _powers(SECTION + length)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(table[part] * ups[:len(part)], out=sums[1:])
        grams = _finish((sums[gram:] - sums[:-gram]) * downs[:len(part) - gram + 1])
        anchor = _leftmost_least(grams, length - gram + 1)  # by window
        text = np.searchsorted(ends, np.arange(start, start + len(anchor)), side="right")
        inside = np.arange(start + length, start + length + len(anchor)) <= ends[text]
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1]))
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(anchor)))
        first, n = first[inside[first]], n[inside[first]]
        stop = first + n + length - 1
        whole = (sums[stop] - sums[first]) * downs[first]
        shape = (anchor[first] - first).astype(np.uint64) * np.uint64(1 << 20) + n.astype(np.uint64)
        found.append((text[first], grams[anchor[first]], _finish(whole ^ _finish(shape)), first + start, n))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))


def _firsts(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records by (gram, segment, place), and which are the first of their gram and segment, or the same window again."""
    records = records[np.lexsort((records["at"], records["hash"], records["doc"], records["segment"], records["gram"]))]
    new = np.ones(len(records), bool)
    new[1:] = (records["gram"][1:] != records["gram"][:-1]) | (records["segment"][1:] != records["segment"][:-1])
    return records, new


def _same_place(records: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (records["doc"] == other["doc"]) & (records["hash"] == other["hash"]) & (records["at"] == other["at"])


def _repeat_of_first(records: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Which records, sorted, repeat the segment of an earlier place."""
    if not len(records):
        return new
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    return ~_same_place(records, records[head])


SPANS = f"{_ID} bigint, {_HASH} bigint, at bigint, n int, gram bigint, state int"
#: state of a row: removed, or a segment to sort, or one whose anchor is hot
REMOVED, SORT, SORT_HOT = 0, 1, 2


def _span_batch(records: np.ndarray, state: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(records["doc"].copy()), pa.array(records["hash"].copy()), pa.array(records["at"].copy()), pa.array(records["n"].copy()),
         pa.array(records["gram"].view("<i8").copy()), pa.array(state.astype(np.int32))],
        [_ID, _HASH, "at", "n", "gram", "state"])


def find_candidates(keyed: DataFrame, parts: int, length: int, gram: int, hot: int) -> DataFrame:
    """Steps 1 and 2 over (_ID, _HASH, text): rows of SPANS."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> Iterator[pa.RecordBatch]:
            records, new = _firsts(np.concatenate(held))
            again = _repeat_of_first(records, new)
            gone, records = records[again], records[new]
            if len(gone):  # removed already; passed on under any number
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(abs(int(gone["doc"][0])) % parts)], pa.int32()), pa.array([True]), pa.array([gone.tobytes()], pa.binary())], ["part", "gone", "records"])
            part = (records["gram"] % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            records, part = records[order], part[order]
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cuts].astype(np.int32)), pa.array([False] * len(cuts), pa.bool_()),
                 pa.array([r.tobytes() for r in np.split(records, cuts[1:])] if len(cuts) else [], pa.binary())], ["part", "gone", "records"])

        rows = 0
        for batch in batches:
            data, ends = text_bytes(batch.column(2))
            docs, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, ends = np.frombuffer(data, np.uint8), np.array(ends, np.int64)
            text, grams, whole, first, n = segments(data, ends, length, gram)
            records = np.empty(len(text), RECORD)
            records["gram"], records["segment"], records["n"] = grams, whole, n
            records["doc"], records["hash"] = docs[text], hashes[text]
            records["at"] = first - np.append(0, ends)[text]
            held.append(records)
            rows += len(records)
            if rows >= HELD:
                yield from out()
                held, rows = [], 0
        if held:
            yield from out()

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for gone, blob in zip(batch.column(1).to_pylist(), batch.column(2)):
                records = np.frombuffer(blob.as_buffer(), RECORD)
                if gone:
                    yield _span_batch(records, np.zeros(len(records), np.int32))
                else:
                    held.append(records)
        if not held:
            return
        records = np.concatenate(held)
        held.clear()
        gram = records["gram"]
        order = np.argsort(gram, kind="stable")
        alone = np.ones(len(order), bool)
        same = gram[order][1:] == gram[order][:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        records, new = _firsts(records[order[~alone]])
        again = _repeat_of_first(records, new)
        yield _span_batch(records[again], np.zeros(int(again.sum()), np.int32))
        records = records[new]
        if len(records):
            group = np.cumsum(np.append(True, records["gram"][1:] != records["gram"][:-1])) - 1
            size = np.bincount(group)[group]
            state = np.where(size > hot, SORT_HOT, SORT)
            yield _span_batch(records[size > 1], state[size > 1])

    dealt = keyed.mapInArrow(lambda batches: released(deal(batches)), "part int, gone boolean, records binary")
    return dealt.repartition(parts, "part").mapInArrow(lambda batches: released(classify(batches)), SPANS)


SEGMENTS = f"key bigint, {_ID} bigint, {_HASH} bigint, at bigint, n int, bytes binary"


def _window_key(window: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)


def cut_segments(batches: Iterator[pa.RecordBatch], text_at: int, length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments listed in the last column. Those of hot anchors go window by window: of equal windows of a
    batch the first, the others without bytes, as they are removed already."""
    for batch in batches:
        docs, hashes, listed = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in (_ID, _HASH, _SPANS))
        rows: list[tuple] = []
        hot: dict[bytes, tuple] = {}
        for doc, own, text, spans in zip(docs, hashes, text_rows(batch.column(text_at)), listed):
            for s in spans:
                at, n = s["at"], s["n"]
                if s["state"] == SORT:
                    rows.append((s["gram"], doc, own, at, n, text[at:at + n + length - 1]))
                    continue
                for p in range(at, at + n):
                    window, here = text[p:p + length], (doc, own, p)
                    first = min(hot.get(window, here), here)
                    later = max(hot.get(window, here), here)
                    hot[window] = first
                    if first != later:
                        rows.append((p, *later, 1, None))
        rows.extend((_window_key(w), *here, 1, w) for w, here in hot.items())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["key", _ID, _HASH, "at", "n", "bytes"])


REMOVALS = f"{_ID} bigint, {_HASH} bigint, at bigint, n int"


def _removal_batch(doc: np.ndarray, own: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(own), pa.array(at), pa.array(n.astype(np.int32))], [_ID, _HASH, "at", "n"])


def sort_segments(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Step 3 over SEGMENTS sorted by key: the windows that repeat an earlier one."""
    held: list[pa.RecordBatch] = []
    size = 0

    def run(table: pa.Table) -> pa.RecordBatch:
        doc, own, at, n = (table.column(c).to_numpy() for c in (_ID, _HASH, "at", "n"))
        blobs = table.column("bytes").to_pylist()
        data = np.frombuffer(b"".join(blobs) + bytes(WORD), np.uint8)
        begin = np.cumsum([0, *map(len, blobs)])[:-1]
        row = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        order, leaf = deep_shallow(data, begin[row] + k, length)
        row, k = row[order], k[order]
        several = np.bincount(leaf)[leaf] > 1
        row, k, leaf = row[several], k[several], leaf[several]
        sort = np.lexsort((at[row] + k, own[row], doc[row], leaf))
        row, k, leaf = row[sort], k[sort], leaf[sort]
        if len(leaf):
            new = np.append(True, leaf[1:] != leaf[:-1])
            head = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = (doc[row] != doc[row[head]]) | (own[row] != own[row[head]]) | (at[row] + k != at[row[head]] + k[head])
            row, k = row[later], k[later]
        sort = np.lexsort((k, row))
        row, k = row[sort], k[sort]
        new = np.append(True, (row[1:] != row[:-1]) | (k[1:] != k[:-1] + 1)) if len(row) else np.zeros(0, bool)
        head = np.flatnonzero(new)
        return _removal_batch(doc[row[head]], own[row[head]], at[row[head]] + k[head], np.diff(np.append(head, len(row))))

    for batch in batches:
        gone = batch.filter(batch.column(5).is_null())
        if gone.num_rows:
            yield _removal_batch(*(gone.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5)))
        batch = batch.filter(batch.column(5).is_valid())
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= SORT_BYTES:
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield run(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size = sum(b.nbytes for b in held)
    if held:
        yield run(pa.Table.from_batches(held))


def _by_document(spans: DataFrame, columns: list[str]) -> DataFrame:
    """The spans of each document as one list; a list is never longer than its document."""
    return spans.groupBy(_ID, _HASH).agg(F.collect_list(F.struct(*columns)).alias(_SPANS))


def merge(spans: list, size: int, length: int) -> list[tuple[int, int]]:
    """Removed runs of bytes, in order, from runs of windows."""
    runs: list[list[int]] = []
    for at, stop in sorted((s["at"], min(size, s["at"] + s["n"] + length - 1)) for s in spans or ()):
        if runs and at <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([at, stop])
    return [(a, b) for a, b in runs]


def with_repeats(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, hot: int = HOT_ANCHOR) -> DataFrame:
    """The documents with the list of their repeated windows in the last column."""
    prepare(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = max(12, total // TEXT_PART + 1)
    keyed = docs.withColumns({
        _ID: F.coalesce(F.col(id_col).cast("bigint"), F.lit((1 << 63) - 1)),
        _HASH: F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))),
    })
    slim = keyed.select(_ID, _HASH, F.col(text_col).cast("string")).where(F.octet_length(text_col) >= length)
    found = store(find_candidates(slim, max(12, total // ANCHOR_PART + 1), length, gram, hot), "candidates")

    dealt = keyed.repartition(parts, _ID, _HASH)
    open_ = _by_document(found.where(F.col("state") != REMOVED), ["at", "n", "gram", "state"])
    text_at = docs.columns.index(text_col)
    cut = dealt.join(open_.hint("shuffle_hash"), [_ID, _HASH]).select(*docs.columns, _ID, _HASH, _SPANS)
    pieces = cut.mapInArrow(lambda batches: released(cut_segments(batches, text_at, length)), SEGMENTS)
    sort_parts = max(12, found.where(F.col("state") != REMOVED).count() // 150_000)
    sorted_ = pieces.repartition(sort_parts, "key").sortWithinPartitions("key")
    repeats = sorted_.mapInArrow(lambda batches: released(sort_segments(batches, length)), REMOVALS)
    removed = found.where(F.col("state") == REMOVED).select(_ID, _HASH, "at", "n").unionByName(repeats)
    return dealt.join(_by_document(removed, ["at", "n"]).hint("shuffle_hash"), [_ID, _HASH], "left").select(*docs.columns, _SPANS)


def repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, gram: int = 28, hot: int = HOT_ANCHOR,
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row; spans lists the removed runs (start, stop) in bytes.

    A null text is empty. A null id comes after all others. Rows with the same id and text are one document: each gets the same
    result, and none repeats another. Rows with the same id and different texts follow the hashes of the texts. Only the two
    columns are read.
    """
    found = with_repeats(docs.select(id_col, text_col), id_col, text_col, length, gram, hot)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(text_rows(batch.column(1)), batch.column(2).to_pylist()):
                runs = merge(spans, len(text), length)
                kept, at = hashlib.sha256(), 0
                for start, stop in runs:
                    kept.update(text[at:start])
                    at = stop
                kept.update(text[at:])
                out.append((len(text), sum(b - a for a, b in runs), len(runs), kept.hexdigest(), [{"start": a, "stop": b} for a, b in runs]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in out], k) for i, k in enumerate(kinds))],
                [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return found.mapInArrow(run, f"{id_col} {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                                 "spans array<struct<start: bigint, stop: bigint>>")


def cut_text(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """The text without the runs; a code point of several bytes goes only if all its bytes do."""
    kept, at = [], 0
    for start, stop in runs:
        while start < stop and text[start] & 0xC0 == 0x80:  # begins inside a code point, which stays
            start += 1
        while stop < len(text) and stop > start and text[stop] & 0xC0 == 0x80:  # ends inside one
            stop -= 1
        kept.append(text[at:start])
        at = max(at, stop)
    return b"".join([*kept, text[at:]])


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, gram: int = 28, chars_col: str | None = "n_chars",
) -> DataFrame:
    """The rows with their texts cut as ``repeats`` finds (whole code points only), all columns kept.

    ``chars_col``, if the table has it, gets the new number of code points. Null texts stay null.
    """
    found = with_repeats(docs, id_col, text_col, length, gram)
    text_at = docs.columns.index(text_col)
    chars_at = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(batch.columns[:-1])
            texts = [cut_text(t, merge(s, len(t), length)).decode("utf-8", "replace")
                     for t, s in zip(text_rows(batch.column(text_at)), batch.column(-1 + batch.num_columns).to_pylist())]
            old = made[text_at].is_null().to_pylist()
            made[text_at] = pa.array([None if gone else t for t, gone in zip(texts, old)], pa.string())
            if chars_at is not None:
                made[chars_at] = pa.array([None if gone else len(t) for t, gone in zip(texts, old)], made[chars_at].type)
            yield pa.RecordBatch.from_arrays(made, docs_names)

    docs_names = docs.columns
    return found.mapInArrow(run, StructType(docs.schema.fields))
