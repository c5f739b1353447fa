from collections import Counter

import pyarrow as pa
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lectern.llm import tokens

WORDS = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(WORDS)


def want(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab1'Éé \n\t<|endoftext|>́ \U0001f600", max_size=60), max_size=8))
def test_batches_like_the_library(texts):
    wanted = [want(t) for t in texts]
    assert tokens.count_words(pa.array(texts, pa.string()), WORDS, 16).tolist() == wanted
    assert tokens.count_batch([t.encode() for t in texts], WORDS, 8).tolist() == wanted


def test_special_strings_count_once():
    assert want("a <|endoftext|> b") == tokens.count_words(pa.array(["a <|endoftext|> b"]), WORDS)[0] == 3


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_files(name, sample):
    texts = [r.text.encode() for r in sample.limit(20).collect()]
    path = P.path(name)
    assert tokens.count_batch(texts, path, 500).tolist() == [int(tokens.count_batch([t], path, 1 << 30)[0]) for t in texts]


def test_pieces_join_to_the_text():
    text = ("some words 12 and\nmore " * 400).encode()
    pieces = tokens.safe_pieces(text, 100)
    assert b"".join(pieces) == text and max(map(len, pieces)) < 140
    assert tokens.safe_pieces(b"x" * 1000, 100) == [b"x" * 1000]


def test_edges(edges, edge_rows):
    for drops_space in (True, False):
        got = tokens.token_counts(edges, WORDS, drops_space=drops_space).collect()
        wanted = Counter((r[0], len((r[1] or "").encode()), want(r[1]), want(r[1]) > 2048) for r in edge_rows)
        assert Counter(map(tuple, got)) == wanted
    assert tokens.token_counts(edges.limit(0), WORDS).collect() == []
