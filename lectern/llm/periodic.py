"""Periodic runs of words, by the branching tandem test on an enhanced suffix array.

A run of period q is a longest stretch in which words q apart are equal. Its last square (two periods in a row) can't be moved
to the right; the two suffixes where its halves begin part after exactly q words, so they lie in different children of one LCP
interval of depth q. For each interval the suffixes of all children but the largest are tested: whether the suffix q further on,
or q before, is in the interval too, by the inverse suffix array. That is n log n tests, and no tree is built; an interval is
two bounds. Squares are then moved to the left as far as they go, which gives the runs, and multiples of a period fall together.

Before that, each text is cut to what can hold a run of ``least_words`` words and ``least_periods`` periods: inside such a run
every word is covered by a window of ``_window`` words that is in the text twice. Windows are compared by hash, so a chance hit
only keeps more words. A text is worked on by itself, whole; a task holds one Arrow batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import prepare, released, text_rows

#: Suffixes tested at a time.
BLOCK = 1 << 20
WORD = r"[ \x09-\x0D]+"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window(least_words: int, least_periods: int) -> int:
    """Words of the shortest window that any run of such a size repeats: a run of period q holds all its windows of length - q."""
    return max(1, min(max(least_words, least_periods * q) - q for q in range(1, least_words + 1)))


def repeated_stretches(words: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Which words are covered by a window that its text has twice. ``ends`` are the ends of the texts in ``words``."""
    n = len(words)
    if n <= window:
        return np.zeros(n, bool)
    base = 0xD1342543DE82EF95
    ups, downs = np.full(n, np.uint64(base)), np.full(n, np.uint64(pow(base, -1, 1 << 64)))
    ups[0] = downs[0] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_mix(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.multiply.accumulate(ups), out=sums[1:])
    at = np.arange(n - window + 1)
    text = np.searchsorted(ends, at, side="right")
    hashes = (sums[window:] - sums[:-window]) * np.multiply.accumulate(downs)[:len(at)]
    hashes = _mix(hashes ^ _mix(text.astype(np.uint64)))
    inside = at + window <= ends[text]
    at, hashes = at[inside], hashes[inside]
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = at[twice]
    edge = np.bincount(at, minlength=n + 1)[:n + 1].astype(np.int64)
    edge -= np.bincount(at + window, minlength=n + 1)[:n + 1]
    return np.cumsum(edge)[:n] > 0


def suffix_order(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, inverse) by prefix doubling; a suffix leaves the sort as soon as its place is known."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    new = np.append(True, s[order][1:] != s[order][:-1])
    slot = np.flatnonzero(new)[np.cumsum(new) - 1]  # a group's first place is its rank
    rank = np.empty(n, np.int64)
    rank[order] = slot
    step = 1
    places = np.arange(n)
    while True:
        group = rank[order[places]]
        shared = np.zeros(len(places), bool)
        same = group[1:] == group[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        places = places[shared]
        if not len(places):
            return order, rank
        suffix = order[places]
        follow = suffix + step
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)], -1)
        group = rank[suffix]
        sort = np.lexsort((second, group))
        suffix, second, group = suffix[sort], second[sort], group[sort]
        order[places] = suffix
        new = np.append(True, (group[1:] != group[:-1]) | (second[1:] != second[:-1]))
        rank[suffix] = places[np.flatnonzero(new)[np.cumsum(new) - 1]]
        step *= 2


def common_prefixes(s: np.ndarray, order: np.ndarray, inverse: np.ndarray) -> list[int]:
    """Words that each suffix shares with the one before it in the order."""
    values, before, n = s.tolist(), order.tolist(), len(s)
    lcp, h = [0] * n, 0
    for i, place in enumerate(inverse.tolist()):
        if place == 0:
            h = 0
            continue
        j = before[place - 1]
        top = n - max(i, j)
        while h < top and values[i + h] == values[j + h]:
            h += 1
        lcp[place] = h
        if h:
            h -= 1
    return lcp


def smaller_children(lcp: list[int], deepest: int) -> Iterator[tuple[int, int, int, int, int]]:
    """For every LCP interval of depth 1 to ``deepest``: (depth, first, last, from, to), once or twice; from .. to are its
    suffixes before, and after, its largest child."""
    depth, first, best, best_at = [0], [0], [0], [0]
    for i in range(1, len(lcp) + 1):
        h = lcp[i] if i < len(lcp) else -1
        start = i - 1
        while depth[-1] > h:
            if i - start > best[-1]:
                best[-1], best_at[-1] = i - start, start
            d, start, size, at = depth.pop(), first.pop(), best.pop(), best_at.pop()
            if 0 < d <= deepest:
                if at > start:
                    yield d, start, i - 1, start, at
                if at + size < i:
                    yield d, start, i - 1, at + size, i
            if not depth:
                return
        if depth[-1] == h:
            if i - start > best[-1]:
                best[-1], best_at[-1] = i - start, start
        else:
            depth.append(h)
            first.append(start)
            best.append(i - start)
            best_at.append(start)


def last_squares(s: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square that can't be moved to the right, for periods up to ``longest``."""
    order, inverse = suffix_order(s)
    lcp = common_prefixes(s, order, inverse)
    n, starts, periods = len(s), [], []

    def test(rows: np.ndarray) -> None:
        size = rows[:, 4] - rows[:, 3]
        d, low, high = (np.repeat(rows[:, c], size) for c in range(3))
        i = order[np.arange(len(d)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(rows[:, 3], size)]
        for begin, other in ((i, i + d), (i - d, i - d)):
            here = (other >= 0) & (other < n)
            place = inverse[np.where(here, other, 0)]
            here &= (place >= low) & (place <= high)
            b, p = begin[here], d[here]
            moves = np.zeros(len(b), bool)
            stop = b + 2 * p
            moves[stop < n] = s[stop[stop < n]] == s[(stop - p)[stop < n]]
            starts.append(b[~moves])
            periods.append(p[~moves])

    held, size = [], 0
    for found in smaller_children(lcp, longest):
        held.append(found)
        size += found[4] - found[3]
        if size >= BLOCK:
            test(np.array(held))
            held, size = [], 0
    if held:
        test(np.array(held))
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def moved_left(s: np.ndarray, start: int, period: int) -> int:
    """Where a square from ``start`` begins after moving to the left as far as it stays a square."""
    step = 64
    while start > 0:
        low = max(0, start - step)
        differ = np.flatnonzero(s[low:start] != s[low + period:start + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        start, step = low, step * 2
    return 0


def runs_of(s: np.ndarray, least_words: int, least_periods: int, longest: int) -> list[tuple[int, int, int]]:
    """(start, stop, period) of the runs of an array with at least so many words and periods."""
    start, period = last_squares(s, longest)
    need = np.maximum(least_words, least_periods * period) - 2 * period
    for back in range(1, 9):  # most squares don't move far
        fits = need < back
        far = ~fits & (start >= back)
        fits[far] = s[start[far] - back] == s[start[far] - back + period[far]]
        start, period, need = start[fits], period[fits], need[fits]
    stop = start + 2 * period
    sort = np.lexsort((period, stop))
    found: list[tuple[int, int, int]] = []
    known: list[tuple[int, int]] = []
    last = -1
    for a, q, b in zip(start[sort].tolist(), period[sort].tolist(), stop[sort].tolist()):
        if b != last:
            last, known = b, []
        if any(q % p == 0 and a >= first for first, p in known):
            continue  # the same run, at a multiple of its period
        first = moved_left(s, a, q)
        known.append((first, q))
        if b - first >= max(least_words, least_periods * q):
            found.append((first, b, q))
    return found


def batch_runs(texts: list[list[bytes]], least_words: int, least_periods: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, given as words; by start, then period."""
    parts, base = [], 0
    for words in texts:
        number = {w: base + i for i, w in enumerate(dict.fromkeys(words))}
        parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        base += len(number)
    ends = np.cumsum([len(p) for p in parts])
    words = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    place = np.flatnonzero(repeated_stretches(words, ends, _window(least_words, least_periods)))
    if not len(place):
        return out
    text = np.searchsorted(ends, place, side="right")
    begins = np.append(True, (place[1:] != place[:-1] + 1) | (text[1:] != text[:-1]))
    stretch = np.cumsum(begins) - 1
    # each stretch ends on a number of its own
    s = np.full(len(place) + stretch[-1] + 1, -1, np.int64)
    origin = np.full(len(s), -1, np.int64)
    at = np.arange(len(place)) + stretch
    s[at], origin[at] = words[place], place
    closing = np.flatnonzero(s < 0)
    s[closing] = base + np.arange(len(closing))
    sizes = np.bincount(stretch)
    for a, b, q in runs_of(s, least_words, least_periods, int(sizes.max()) // least_periods):
        t = int(np.searchsorted(ends, origin[a], side="right"))
        out[t].append((int(origin[a] - (ends[t] - len(parts[t]))), b - a, q))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without what lies in a run after its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 24, least_periods: int = 3,
) -> DataFrame:
    """(id, runs, collapsed) of every row. runs lists (start, length, period) in words, by start, then period: the longest
    stretches with that smallest period, of at least ``least_words`` words and ``least_periods`` (two or more) periods; words are
    what lies between ASCII white space. collapsed is the text with one period of each run, its words joined by one space.

    A null, empty or blank text has no runs and collapses to an empty string. Each row is judged by itself, so repeated rows and
    rows with a null id come out as often as they came in. An empty table gives no rows. Only the two columns are read.
    """
    if least_periods < 2:
        raise ValueError("a run has two periods or more")
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.split() for t in text_rows(batch.column(1))]
            found = batch_runs(texts, least_words, least_periods)
            listed = [[{"start": a, "length": n, "period": q} for a, n, q in r] for r in found]
            kept = [collapsed(w, r).decode("utf-8") for w, r in zip(texts, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(listed, pa.list_(RUN)), pa.array(kept, pa.string())], [id_col, "runs", "collapsed"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        lambda batches: released(run(batches)),
        f"{id_col} {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """The columns of ``periodic_runs`` as counts, the run of greatest exact exponent (ties: start, then period) and digests."""
    runs = F.col("runs")
    greater = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    # runs are in the order that decides ties, so only a greater one replaces the first
    best = F.when(F.size(runs) > 0, F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, 0),
                                                lambda m, r: F.when(greater(r, m), r).otherwise(m)))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
    others = [c for c in found.columns if c not in ("runs", "collapsed")]
    found = found.withColumn("best", best)
    return found.select(
        *others, F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of the query: in a tenth of them, by a checksum of the id, the words from some place on repeat the first
    few there. Other texts, those of a null id and texts without a word stay as they are."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(text_col, WORD), lambda w: w != "")
    made = docs.select(F.col(id_col), F.col(text_col), h.alias("__h"), F.when(h % 10 == 0, words).alias("__w"))
    made = made.withColumns({"__n": F.size("__w").cast("bigint"), "__g": F.expr("__h div 10")})
    made = made.withColumn("__a", F.when(F.col("__n") > 0, F.col("__g") % F.col("__n")))
    made = made.withColumn("__p", F.expr("1 + (__n - __a) div (3 + __g % 8)"))
    tail = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - F.col("__a") - 1),
                       lambda i: F.get(F.col("__w"), (F.col("__a") + i % F.col("__p")).cast("int")))
    whole = F.array_join(F.concat(F.slice("__w", F.lit(1), F.col("__a").cast("int")), tail), " ")
    return made.select(id_col, F.when(F.col("__n") > 0, whole).otherwise(F.col(text_col)).alias(text_col))
