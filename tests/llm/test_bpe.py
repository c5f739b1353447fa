import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st

from lectern.llm import bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = bpe.load(RANKS, P.PATTERN)


def want(text):
    ids = np.array(LIBRARY.encode_ordinary(text or ""), "<u4").tobytes()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1'sé \n\t.!\U0001f600 ", min_size=2, max_size=80), st.integers(1, 79))
def test_cuts_at_boundaries_are_safe(text, at):
    for end in bpe.boundaries(text, P.PATTERN, 0, at):
        assert LIBRARY.encode_ordinary(text[:end]) + LIBRARY.encode_ordinary(text[end:]) == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("chunk,overlap", [(40, 12), (300, 60), (bpe.CHUNK, bpe.OVERLAP)])
def test_like_the_library(spark, chunk, overlap):
    texts = ["a" * 3000 + " b" * 400, " \n\n  \t " * 100 + "it's  we'll\n\n\n x" * 60, "naïve Straße 12345 don't " * 50, "…" * 200 + "x", "\U0001f600" * 99, "x", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in bpe.encode(df, RANKS, P.PATTERN, chunk=chunk, overlap=overlap, give_ids=True).collect()}
    for i, text in enumerate(texts):
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want(text)
    back = bpe.decode(bpe.encode(df, RANKS, P.PATTERN, chunk=chunk, overlap=overlap, give_ids=True), RANKS, P.PATTERN)
    assert {r.doc_id: bytes(r.bytes).decode() for r in back.collect()} == dict(enumerate(texts))


def test_edges(edges, edge_rows):
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(edges, RANKS, P.PATTERN).collect())
    assert got == Counter((r[0], *want(r[1])) for r in edge_rows)
    assert bpe.encode(edges.limit(0), RANKS, P.PATTERN).collect() == []
