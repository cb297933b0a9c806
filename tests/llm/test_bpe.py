from __future__ import annotations

import hashlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings, strategies as st

from agora.llm import bpe


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.Encoder(bpe.PerfectHash(ranks), public_tokenizers.PATTERN)


def test_perfect_hash_is_minimal_and_exact(ranks):
    table = bpe.PerfectHash(ranks)
    assert table.n == len(ranks) and None not in table.keys
    assert all(table.get(k) == r for k, r in ranks.items())
    assert table.get(b"not a vocabulary entry") is None


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), dtype="<u4").tolist()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_encodes_as_tiktoken(encoder, reference, text):
    assert ids(encoder, text) == reference.encode_ordinary(text)


@pytest.mark.parametrize("text", ["", "a" * 20_000, " " * 999 + "x", "<|endoftext|>", "é̈ 你好 😀\n\n\t x",
                                  "Ciónñez über   hentha’s we'll 12345 %%%***"])
def test_edges_as_tiktoken(encoder, reference, text):
    assert ids(encoder, text) == reference.encode_ordinary(text)


def test_rows(spark, ranks, reference):
    texts = ["Hello hello  world", None, "", "Hello hello  world", "ß" * 3000]
    df = spark.createDataFrame([(i if i != 1 else None, t, "x") for i, t in enumerate(texts)],
                               "doc_id long, text string, ids string")
    got = bpe.digests(df, ranks, public_tokenizers.PATTERN).collect()
    assert len(got) == 5
    for row, text in zip(sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id)),
                         [texts[1], texts[0], *texts[2:]]):
        want = reference.encode_ordinary(text or "")
        assert row.n_tokens == len(want)
        assert row.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.digests(df.limit(0), ranks, public_tokenizers.PATTERN).count() == 0
