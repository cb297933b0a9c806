from __future__ import annotations

import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from agora.llm import bpe, fertility


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read(), bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "d"]), max_size=30))
def test_repeated_words(words):
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) for k in range(3)
              if windows[tuple(words[i:i + 3])] > 1}
    assert fertility.repeated_words(words) == len(inside)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85\xa0 aé#|", max_size=40))
def test_base_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    assert fertility.split_words(text) == words
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    assert fertility.duplicate_lines(text) == dups


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=8).filter(lambda w: len(w.encode().split()) == 1
                                                       and not w.encode()[:1].isspace()
                                                       and not w.encode()[-1:].isspace()), max_size=8))
def test_words_encoded_together_as_alone(model, words):
    m = fertility.Measure(*MODELS.setdefault(0, model), public_tokenizers.PATTERN) \
        if 1 not in MODELS else MODELS[1]
    MODELS[1] = m
    assert m.piece_ids(words) == [m.pieces.encode(w) for w in words]
    assert m.byte_counts(words) == [len(m.bytes_of.encode_ordinary(" " + w)) for w in words]


MODELS: dict = {}


def prose(rng, n=120):
    vocab = ["the", "house", "of", "water", "small", "garden", "people", "under", "light",
             "morning", "river", "stone", "and", "walks", "again", "quiet", "letter", "winter"]
    return " ".join(rng.choice(vocab) for _ in range(n))


def test_rules(spark, model):
    rng = random.Random(1)
    good = prose(rng)
    texts = {0: good, 1: " ".join(w + "***" for w in good.split()), 2: "word " * 200, 3: "",
             4: None, 5: "short text", 6: " | ".join(good.split()), 7: good, 8: "x" * 5000}
    df = spark.createDataFrame([(k, t, "z") for k, t in texts.items()] + [(None, good, "z")],
                               "doc_id long, text string, kept string")
    got = {r.doc_id: r for r in fertility.rules(df, *model, public_tokenizers.PATTERN).collect()}
    assert len(got) == 10
    assert {k for k, r in got.items() if r.kept} == {0, 7, None}
    assert {k for k, r in got.items() if r.base_failed} == {2, 3, 4, 5, 6, 8}
    assert got[3].n_words == got[4].n_words == 0 and got[4].piece_chars is None
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model[0])
    n = sum(len(pieces.encode(w)) for w in good.split())
    assert got[0].n_tokens == n and got[0].piece_chars == got[0].word_chars / n
    assert got[1].n_symbols == 3 * 120
    assert fertility.rules(df.limit(0), *model, public_tokenizers.PATTERN).count() == 0
