"""Quality rules: base rules on words and lines, and the divergence of a document from its language.

For each language the corpus gives two reference histograms: character classes, and its most common words plus one bin for
all others. A language with too few words for that is compared with those of all documents and of the other languages. A document is rejected when the Jensen-Shannon distance (square root of the divergence in bits, 0 to 1) to a
reference is above a limit. Short documents scatter: a text under the guard lengths isn't compared, and the divergence that
a sample of its length has on average is taken off first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from lectern.llm.common import prepare, released, store, text_bytes

# The symbols that the base rules count.
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other ascii", "beyond ascii")
SYMBOL = CLASSES.index("symbol")
_SKIP = len(CLASSES)  # continuation bytes of a code point


@dataclass(frozen=True)
class Rules:
    """Parameters of the divergence rule."""

    common_words: int = 50  # words of a language's histogram
    word_bytes: int = 64  # longer words are never common words
    least_share: float = 0.001  # of the corpus's words from which every document may be near a language: 1000 of them at most
    least_words: int = 20_000  # or so many words give a language a reference for its own documents
    guard_words: int = 50  # documents of fewer words aren't compared by words
    guard_chars: int = 200  # or by classes with fewer code points
    class_limit: float = 0.3
    word_limit: float = 0.22  # of an endless text; short ones scatter by the square root of their words
    word_scatter: float = 1.05

    def accepts(self, by_class: np.ndarray, by_word: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        return (by_class <= self.class_limit) & (by_word <= self.word_limit + self.word_scatter / np.sqrt(np.maximum(n_words, 1)))


def _classes() -> np.ndarray:
    table = np.full(256, CLASSES.index("other ascii"), dtype=np.uint8)
    for name, members in (
        ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("space", [32, *range(9, 14)]),
        ("stop", b".,;:?!'\"()-"), ("symbol", SYMBOLS), ("beyond ascii", range(0xC0, 256)),
    ):
        table[list(members)] = CLASSES.index(name)
    table[0x80:0xC0] = _SKIP
    return table


_TABLE = _classes()


def _codes(values: np.ndarray) -> np.ndarray:
    return pa.array(values).dictionary_encode().indices.to_numpy(zero_copy_only=False)


def _repeated_words(doc: np.ndarray, code: np.ndarray, kinds: int, docs: int) -> np.ndarray:
    """Words per document that stand in a 3-word window found twice or more in it."""
    if len(code) < 3:
        return np.zeros(docs, np.int64)
    at = np.flatnonzero(doc[2:] == doc[:-2])
    code = code.astype(np.int64)
    pair = code[at] * kinds + code[at + 1]
    if kinds >= 1 << 21:  # three codes would not fit in 63 bits
        pair = _codes(pair).astype(np.int64)
    window = _codes(_codes(pair * kinds + code[at + 2]).astype(np.int64) * docs + doc[at])
    again = at[np.bincount(window)[window] > 1] if len(at) else at
    marked = np.zeros(len(code), bool)
    for k in range(3):
        marked[again + k] = True
    return np.bincount(doc[marked], minlength=docs)


def _duplicate_lines(texts: pa.Array, docs: int) -> np.ndarray:
    lines = pc.split_pattern(texts, "\n")
    doc = pc.list_parent_indices(lines).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(lines)
    worded = pc.and_(pc.greater(pc.binary_length(flat), 0), pc.invert(pc.ascii_is_space(flat))).to_numpy(zero_copy_only=False)
    code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc, code = doc[worded], code[worded]
    different = np.unique(code * docs + doc) % docs if len(doc) else doc
    return np.bincount(doc, minlength=docs) - np.bincount(different, minlength=docs)


class Measures:
    """The base measures, words and class histogram of the texts of a batch."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        self.docs = docs = len(texts)
        data, ends = text_bytes(texts)
        classes = _TABLE[np.frombuffer(data, np.uint8)]
        self.classes = np.array(
            [np.bincount(classes[s:e], minlength=_SKIP + 1)[:_SKIP] for s, e in zip([0, *ends], ends)], dtype=np.int64,
        ).reshape(-1, len(CLASSES))
        parts = pc.ascii_split_whitespace(texts)
        doc, flat = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False), pc.list_flatten(parts)
        full = pc.greater(pc.binary_length(flat), 0)
        self.doc, flat = doc[full.to_numpy(zero_copy_only=False)], flat.filter(full)
        encoded = flat.dictionary_encode()
        self.code, self.words = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
        self.n_words = np.bincount(self.doc, minlength=docs)
        self.n_chars = self.classes.sum(axis=1)
        self.word_chars = self.n_chars - self.classes[:, CLASSES.index("space")]
        self.n_symbols = self.classes[:, SYMBOL]
        self.n_repeat_words = _repeated_words(self.doc, self.code, max(1, len(self.words)), docs)
        self.n_dup_lines = _duplicate_lines(texts, docs)
        self.base_failed = (self.n_words < 50) | (100 * self.n_repeat_words > 50 * self.n_words)


def _language_rows(values: pa.Array) -> dict[str, np.ndarray]:
    """Rows of a batch by language; a null language is the empty one."""
    encoded = values.cast(pa.string()).fill_null("").dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    return {name: np.flatnonzero(codes == k) for k, name in enumerate(encoded.dictionary.to_pylist())}


def _counts(texts: pa.Array, languages: pa.Array, rules: Rules) -> Iterator[tuple[str, str, np.ndarray, pa.Array]]:
    """(language, kind, counts, names) of the texts that pass the base rules."""
    m = Measures(texts)
    short = pc.less_equal(pc.binary_length(m.words), rules.word_bytes).to_numpy(zero_copy_only=False)
    for language, rows in _language_rows(languages).items():
        good = np.zeros(m.docs, bool)
        good[rows] = ~m.base_failed[rows]
        if not good.any():
            continue
        yield language, "class", m.classes[good].sum(axis=0), pa.array(CLASSES)
        n = np.bincount(m.code[good[m.doc]], minlength=len(m.words))
        yield language, "total", n.sum(keepdims=True), pa.array([""])
        used = np.flatnonzero((n > 0) & short)
        yield language, "word", n[used], m.words.take(pa.array(used))


#: Counted words that a task holds before it sums and emits them.
HELD_ROWS = 150_000
SCHEMA = "language string, kind string, name string, n bigint"


#: The name of the references of all documents; no language, as a null one is empty.
ALL = None


def _reference(words: list[str], counts: list[int], total: int, classes: dict[str, int]) -> dict:
    by_word = np.array([*counts, total - sum(counts)], dtype=float)
    by_class = np.array([classes.get(c, 0) for c in CLASSES], dtype=float)
    return {"words": words, "word": by_word / by_word.sum(), "class": by_class / by_class.sum()}


def references(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang") -> tuple[dict, DataFrame | None]:
    """Histograms from all documents that pass the base rules: by language for the common ones and under ``ALL`` for all
    documents; and those of the other languages with enough words as a table (language, reference), if there are any.

    Counted per task, summed in Spark. What reaches the driver is bounded: 1 / least_share languages, each with
    common_words words of word_bytes bytes and the classes.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0

        def out() -> Iterator[pa.RecordBatch]:
            table = pa.concat_tables(held).group_by(["language", "kind", "name"]).aggregate([("n", "sum")])
            yield from table.rename_columns(["language", "kind", "name", "n"] if table.column_names[0] == "language"
                                            else ["n", "language", "kind", "name"]).select(["language", "kind", "name", "n"]).to_batches(50_000)

        for batch in batches:
            for language, kind, n, names in _counts(batch.column(0), batch.column(1), rules):
                held.append(pa.table({
                    "language": pa.array([language] * len(n)), "kind": pa.array([kind] * len(n)),
                    "name": names.cast(pa.string()), "n": pa.array(n.astype(np.int64)),
                }))
                rows += len(n)
            if rows > HELD_ROWS:
                yield from out()
                held, rows = [], 0
        if held:
            yield from out()

    counted = docs.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string")).mapInArrow(lambda batches: released(run(batches)), SCHEMA)
    counts = counted.groupBy("language", "kind", "name").agg(F.sum("n").alias("n"))
    counts = store(counts, "counts")
    best = Window.partitionBy("language", "kind").orderBy(F.desc("n"), "name")
    top = store(counts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= max(rules.common_words, len(CLASSES))), "words")
    totals = top.where(F.col("kind") == "total")
    every = totals.agg(F.sum("n")).first()[0] or 0
    if not every:
        return {}, None
    least = rules.least_share * every
    found: dict[str | None, dict] = {}
    shares = totals.where(F.col("n") >= least)
    for r in top.join(shares.select("language"), "language").orderBy("language", "kind", "place").collect():
        found.setdefault(r.language, {"class": {}, "word": {}, "total": {}})[r.kind][r.name] = r.n
    whole = counts.groupBy("kind", "name").agg(F.sum("n").alias("n"))
    most = whole.where("kind = 'word'").orderBy(F.desc("n"), "name").limit(rules.common_words)
    for r in most.unionByName(whole.where("kind <> 'word'")).collect():
        found.setdefault(ALL, {"class": {}, "word": {}, "total": {}})[r.kind][r.name] = r.n
    made = {}
    for language, x in found.items():
        words = list(x["word"].items())[:rules.common_words]
        made[language] = _reference([w for w, _ in words], [n for _, n in words], x["total"][""], x["class"])
    own = totals.where((F.col("n") < least) & (F.col("n") >= rules.least_words)).select("language", F.col("n").alias("all_words"))
    if own.isEmpty():
        return made, None
    word = F.when((F.col("kind") == "word") & (F.col("place") <= rules.common_words), F.struct("place", "name", "n"))
    some = top.join(own, "language").groupBy("language", "all_words").agg(
        F.array_sort(F.collect_list(word)).alias("found"),
        *(F.sum(F.when((F.col("kind") == "class") & (F.col("name") == c), F.col("n")).otherwise(0)).alias(f"c{i}") for i, c in enumerate(CLASSES)))
    classes = [F.col(f"c{i}") for i in range(len(CLASSES))]
    counted_words = F.aggregate("found.n", F.lit(0).cast("bigint"), lambda total, n: total + n)
    shown = some.withColumn("cs", F.array(*classes)).withColumn("rest", F.col("all_words") - counted_words).select(
        "language",
        F.struct(
            F.col("found.name").alias("words"),
            F.transform(F.concat(F.col("found.n"), F.array("rest")), lambda n: n / F.col("all_words")).alias("word"),
            F.transform("cs", lambda n: n / sum(classes[1:], classes[0])).alias("class")).alias("reference"))
    return made, store(shown, "references")


def _with_own(docs: DataFrame, lang_col: str, own: DataFrame | None) -> DataFrame:
    """The documents with the reference of their language as the last column, where it is one of ``own``."""
    if own is None:
        return docs
    kind = own.select("language", F.col("reference").alias("__reference"))
    return docs.join(kind, F.coalesce(F.col(lang_col).cast("string"), F.lit("")) == kind["language"], "left").drop(kind["language"])


def _own_references(languages: pa.Array, column: pa.Array | None) -> dict[str, dict]:
    """The joined references of a batch by language."""
    found: dict[str, dict] = {}
    if column is None:
        return found
    for language, rows in _language_rows(languages).items():
        ref = column[int(rows[0])].as_py() if len(rows) else None
        if ref:
            found[language] = {"words": ref["words"], "word": np.array(ref["word"]), "class": np.array(ref["class"])}
    return found


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to a distribution, less what a sample of its size scatters."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    q = np.broadcast_to(reference, p.shape)
    m = (p + q) / 2

    def against(a: np.ndarray) -> np.ndarray:
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)

    divergence = (against(p) + against(q)) / 2
    expected = np.maximum(total, 1) * reference
    scatter = np.minimum(expected, 1).sum(axis=1) / (8 * np.log(2) * np.maximum(total[:, 0], 1))
    return np.sqrt(np.clip(divergence - scatter, 0, 1))


def judge(
    texts: pa.Array, languages: pa.Array, made: dict[str | None, dict], rules: Rules, joined: pa.Array | None = None,
) -> tuple[Measures, dict[str, np.ndarray]]:
    """Measures, and the distances and verdicts: to the document's own language or, where that rejects it, to another that accepts
    it. A language without a reference has that of all documents."""
    m = Measures(texts)
    distance = {"class": np.zeros(m.docs), "word": np.zeros(m.docs)}

    def compare(rows: np.ndarray, ref: dict) -> tuple[np.ndarray, np.ndarray]:
        bins = pc.index_in(m.words, value_set=pa.array(ref["words"], m.words.type)).fill_null(len(ref["words"])).to_numpy(zero_copy_only=False)
        place = np.full(m.docs, -1)
        place[rows] = np.arange(len(rows))
        own = place[m.doc] >= 0
        width = len(ref["words"]) + 1
        histogram = np.bincount(place[m.doc[own]] * width + bins[m.code[own]], minlength=len(rows) * width).reshape(len(rows), width)
        return (np.where(m.n_chars[rows] >= rules.guard_chars, js_distance(m.classes[rows], ref["class"]), 0),
                np.where(m.n_words[rows] >= rules.guard_words, js_distance(histogram, ref["word"]), 0))

    def near() -> np.ndarray:
        return rules.accepts(distance["class"], distance["word"], m.n_words)

    own = _own_references(languages, joined)
    for language, rows in _language_rows(languages).items():
        ref = made.get(language) or own.get(language) or made.get(ALL)
        if ref:
            distance["class"][rows], distance["word"][rows] = compare(rows, ref)
    for ref in (made[x] for x in made if x is not ALL):  # a wrong language mark is no fault of the text
        rows = np.flatnonzero(~near() & ~m.base_failed)
        if not len(rows):
            break
        by_class, by_word = compare(rows, ref)
        good = rules.accepts(by_class, by_word, m.n_words[rows])
        distance["class"][rows[good]], distance["word"][rows[good]] = by_class[good], by_word[good]
    return m, {"class_distance": distance["class"], "word_distance": distance["word"], "kept": ~m.base_failed & near()}


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, base measures, base_failed, class_distance, word_distance, kept) of every row.

    Nulls: a null text has no words and fails the base rules; a null language is a language of its own; a null id stays null.
    Documents of a language with less than its share of the corpus and fewer than ``least_words`` words are compared with all
    documents, then with the common languages. Repeated rows come out as often as they came in. Only the three columns are read. An empty table gives an empty result.
    """
    made, own = references(docs, rules, text_col, lang_col)
    joined = own is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, found = judge(batch.column(1), batch.column(2), made, rules, batch.column(3) if joined else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(getattr(m, n).astype(np.int64)) for n in MEASURES), pa.array(m.base_failed),
                 pa.array(found["class_distance"]), pa.array(found["word_distance"]), pa.array(found["kept"])],
                [id_col, *MEASURES, "base_failed", "class_distance", "word_distance", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"), F.col(lang_col).cast("string").alias("__lang"))
    return _with_own(rows, "__lang", own).mapInArrow(
        run, f"{id_col} {kind}, " + ", ".join(f"{n} bigint" for n in MEASURES)
        + ", base_failed boolean, class_distance double, word_distance double, kept boolean")


def keep_good(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that ``quality`` keeps, with all their columns."""
    made, own = references(docs, rules, text_col, lang_col)
    text, lang, width, joined = docs.columns.index(text_col), docs.columns.index(lang_col), len(docs.columns), own is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = judge(batch.column(text), batch.column(lang), made, rules, batch.column(width) if joined else None)[1]["kept"]
            yield batch.select(list(range(width))).filter(pa.array(kept))

    return _with_own(docs, lang_col, own).mapInArrow(lambda batches: released(run(batches)), docs.schema)
