"""Token counts with the libraries of public tokenizers."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import prepare, text_rows

#: Bytes of texts that one call of the library encodes; longer texts are cut into pieces of about as many.
CALL_BYTES = 256 << 10
#: A place where every pre-tokeniser with a class for letters or digits ends a token: before one space or line end between
#: two ASCII letters or digits. No merge, normalisation or special token reaches over it.
SAFE = re.compile(rb"[0-9A-Za-z](?=[ \n][0-9A-Za-z])")


def safe_pieces(text: bytes, size: int = CALL_BYTES) -> list[bytes]:
    """The text cut at the first safe place after each ``size`` bytes; without such a place it stays whole."""
    pieces, at = [], 0
    while len(text) - at > size:
        cut = SAFE.search(text, at + size)
        if cut is None:
            break
        pieces.append(text[at:cut.end()])
        at = cut.end()
    return [*pieces, text[at:]]


@lru_cache(maxsize=4)
def _counter(path: str):
    """A function from texts to token counts; one per worker and file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def count_batch(texts: list[bytes], path: str, call_bytes: int = CALL_BYTES) -> np.ndarray:
    """Tokens of each text, encoded in calls of about equal bytes. Sentencepiece marks word starts, so its texts stay whole."""
    count, whole = _counter(path), path.endswith(".model")
    n = np.zeros(len(texts), np.int64)
    held: list[str] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        np.add.at(n, owner, count(held))
        held.clear()
        owner.clear()

    for i, text in enumerate(texts):
        for piece in [text] if whole else safe_pieces(text, call_bytes):
            if held and size + len(piece) > call_bytes:
                flush()
                size = 0
            held.append(piece.decode("utf-8", "replace"))
            owner.append(i)
            size += len(piece)
    if held:
        flush()
    return n


#: Counts of repeated words that a worker remembers; it forgets them all when there are more.
MEMORY = 400_000
_remembered: dict[str, dict[str, int]] = {}


def count_words(column: pa.Array, path: str, call_bytes: int = CALL_BYTES) -> np.ndarray:
    """As ``count_batch``, for tokenizers that drop white space: then each white space is a safe place, the pieces are words,
    and equal words of a batch are encoded once. Calls hold words of about equal bytes in all."""
    parts = pc.ascii_split_whitespace(column.cast(pa.large_string()).fill_null(""))
    row, words = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False), pc.list_flatten(parts).dictionary_encode()
    place = words.indices.to_numpy(zero_copy_only=False)
    known, count = _remembered.setdefault(path, {}), _counter(path)
    different = words.dictionary.to_pylist()
    n = np.fromiter((known.get(w, -1) for w in different), dtype=np.int64, count=len(different))
    new = np.flatnonzero(n < 0)
    call = np.cumsum(pc.binary_length(words.dictionary).to_numpy(zero_copy_only=False)[new]) // call_bytes
    for some in np.split(new, np.flatnonzero(np.diff(call)) + 1):
        n[some] = count([different[i] for i in some]) if len(some) else 0
    again = new[np.bincount(place, minlength=len(different))[new] > 1]
    if len(known) + len(again) > MEMORY:
        known.clear()
    known.update((different[i], int(n[i])) for i in again[:MEMORY])
    return np.bincount(row, weights=n[place], minlength=len(column)).astype(np.int64)


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, drops_space: bool = False,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    path: a .json file for the tokenizers library or a .model file for sentencepiece, at the same place on every executor.
    drops_space: the tokenizer never takes ASCII white space into a token (its pre-tokeniser removes it). Only lengths leave the tasks. A null text is empty and has no tokens; a null id stays null; repeated rows come out as often as
    they came in; an empty table gives an empty result. Only the two columns are read.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).fill_null("")
            n = count_words(texts, path) if drops_space else count_batch(list(text_rows(texts)), path)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, f"{id_col} {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
