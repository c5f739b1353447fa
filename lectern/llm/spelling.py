"""Spelling variants: words one insertion, deletion or replacement apart, found by PartEnum signatures.

A word is a binary vector, its multiset of letters: one replacement makes a Hamming distance of two, one insertion of one. The
letters are dealt to partitions of about equal weight. Vectors within distance k differ in at most k partitions, so they agree on
all others: enumerating every choice of k partitions to leave out, and joining the words whose letters in the rest are equal,
finds every pair within k. Words of one length are joined with k = 2, words whose lengths differ by one with k = 1.

Letters alone leave large groups, as many words are made of the same ones. An edit is in one half of a word, so the other half
is the same in both: each signature is issued twice, with the first and with the second half, and groups become small without
losing a pair. Joined words are verified by edit distance in the join itself.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import prepare, released, store, text_rows

#: What a word is made of: A-Z, a-z and the code points U+00C0 to U+00FF (fixed by the query).
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
#: Partitions of the letters for words of one length (two are left out) and of neighbouring lengths (one is left out).
SAME_PARTS, NEXT_PARTS = 4, 3
#: Different words a task holds before it hands on their counts.
HELD = 100_000


def slipped(word: str, h: int, every: int | None) -> str:
    """The word without one letter if ``every`` divides h."""
    if not every or h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slips: int | None = None) -> DataFrame:
    """(word, n): the runs of letters of all whole texts, A-Z lower-cased, and how often they occur.

    With ``slips`` a word loses a letter in those documents in which the CRC-32 of ``<id>:<word>`` is a multiple of it; a null
    id is an empty string there. Null texts have no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return made

        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), text_rows(batch.column(1))):
                base = zlib.crc32(f"{'' if own is None else own}:".encode())
                for word, n in Counter(LETTERS.findall(text.lower().decode())).items():
                    held[slipped(word, zlib.crc32(word.encode(), base), slips) if slips else word] += n
                if len(held) >= HELD:
                    yield out()
        if held:
            yield out()

    made = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(
        lambda batches: released(run(batches)), "word string, n bigint")
    return made.groupBy("word").agg(F.sum("n").alias("n"))


def letter_parts(words: DataFrame, parts: int) -> list[str]:
    """The letters dealt to partitions, the commonest first and in turns; at most one row for each letter comes to the driver."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    ranked = [r.letter for r in letters.orderBy(F.desc("count"), "letter").collect()]
    dealt = [""] * parts
    for i, letter in enumerate(ranked):
        turn, at = divmod(i, parts)
        dealt[at if turn % 2 == 0 else parts - 1 - at] += letter
    return dealt


def _signatures(words: DataFrame, parts: list[str], left_out: int, size: Column, *tags: Column) -> DataFrame:
    """(sig, word, n): for each choice of partitions to leave out, the letters of the others with the first and with the second
    half of the word; ``size`` is the length that the halves are those of."""
    half = F.floor(size / 2).cast("int")
    ordered = F.array_join(F.array_sort(F.split("word", "")), "")
    halves = [F.substring(F.col("word"), F.lit(1), half), F.substring(F.col("word"), F.char_length("word") - size + half + 1, size - half)]
    made = words.select("word", "n", ordered.alias("letters"), *(h.alias(f"half{i}") for i, h in enumerate(halves)))
    sigs = [F.xxhash64(F.lit(k), F.lit(i), *tags, F.translate("letters", "".join(parts[p] for p in chosen), ""), F.col(f"half{i}"))
            for k, chosen in enumerate(combinations(range(len(parts)), left_out)) for i in range(2)]
    return made.select(F.explode(F.array(*sigs)).alias("sig"), "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, n_near): every two words of (word, n), all different, that are one edit apart, both ways; n_near is the
    count of ``near``."""
    size = F.char_length("word")
    same = _signatures(words, letter_parts(words, SAME_PARTS), 2, size, size)
    parts = letter_parts(words, NEXT_PARTS)
    short = _signatures(words, parts, 1, size, size)
    long = _signatures(words, parts, 1, size - 1, size - 1)
    one = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    pairs = None
    for left, right, apart in ((same, same, F.col("a.word") < F.col("b.word")), (short, long, F.lit(True))):
        found = left.alias("a").join(right.alias("b"), (F.col("a.sig") == F.col("b.sig")) & apart & one).select(
            F.col("a.word").alias("u"), F.col("a.n").alias("n_u"), F.col("b.word").alias("v"), F.col("b.n").alias("n_v"))
        pairs = found if pairs is None else pairs.unionByName(found)
    pairs = pairs.distinct()
    return pairs.select(F.explode(F.array(
        F.struct(F.col("u").alias("word"), F.col("v").alias("near"), F.col("n_v").alias("n_near")),
        F.struct(F.col("v").alias("word"), F.col("u").alias("near"), F.col("n_u").alias("n_near")))).alias("pair")).select("pair.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of forms that starts at each word of (word, form) ends; chains have no loops. Each round
    doubles the steps taken, and is stored."""
    now = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        grown = store(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if grown.where("moved").isEmpty():
            return grown.select("word", "root")
        now = grown.select("word", "root")


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 5, least_count: int = 3, ratio: int = 2,
    slips: int | None = None,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word with ``least_chars`` code points and ``least_count`` occurrences.

    n_near counts the words one edit apart; form is the most frequent of them (ties: the smallest in code-point order) if it has
    at least ``ratio`` times the occurrences, else null; root is where the chain of forms ends, the word itself without one. A
    null or empty text has no words; repeated rows count each time; a null id matters only to ``slips`` (see ``word_counts``).
    An empty table gives no rows. Only the two columns are read. ``ratio`` is above one, so chains can't close.
    """
    if ratio <= 1:
        raise ValueError("a form needs more occurrences than its word")
    prepare(docs.sparkSession)
    counted = word_counts(docs, id_col, text_col, slips)
    words = store(counted.where((F.char_length("word") >= least_chars) & (F.col("n") >= least_count)), "words")
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_near")).alias("fewer"), "near")).alias("best"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.fewer")).alias("near_n"))
    wins = F.col("near_n") >= ratio * F.col("n")
    found = store(found.select("word", "n", "n_near", F.when(wins, F.col("near")).alias("form"), F.when(wins, F.col("near_n")).alias("form_n")), "forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
