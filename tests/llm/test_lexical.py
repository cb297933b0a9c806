import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from agora.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=50):
    """Every document scored by the definition."""
    tfs = [Counter(terms(t)) for _, t in docs]
    n_docs, n_terms = sum(bool(c) for c in tfs), sum(sum(c.values()) for c in tfs)
    df = Counter(t for c in tfs for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), c in zip(docs, tfs):
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[:k])]
    return out


def found(spark, docs, items, k=50):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return [tuple(r) for r in lexical.rank(d, i, k).collect()]


def key(row):
    return (row[0] is None, row[0] or 0, row[1])


DOCS = [(1, "the Cat sat"), (2, None), (3, ""), (4, "cat CAT cat dog"), (5, "Été été2, dog"),
        (6, "the cat sat"), (7, "... --"), (8, "Cat " * 3000 + "zebra"), (None, "dog cat"), (9, "the the the"),
        (6, "the cat sat"), (10, "ÉTÉ x ß 漢字"), (11, "a_b a\x00b")]
ITEMS = [(1, "cat dog"), (2, "été 漢字 b"), (3, None), (4, "nothing here"), (None, "the zebra the"), (1, "sat")]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_equals_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(lexical, "FIRST", 2)
    assert sorted(found(spark, DOCS, ITEMS, k), key=lambda r: (key(r), r[2] is None, r[2] or 0, r[3])) == \
        sorted(brute(DOCS, ITEMS, k), key=lambda r: (key(r), r[2] is None, r[2] or 0, r[3]))


def test_shards_and_blocks_of_any_size_agree(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(words, 1 + int(rng.integers(30))))) for i in range(400)]
    items = [(i, " ".join(rng.choice(words, 12))) for i in range(12)]
    want = sorted(brute(docs, items, 5))
    assert sorted(found(spark, docs, items, 5)) == want
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 20)
    assert sorted(found(spark, docs, items, 5)) == want


@given(st.lists(st.lists(st.integers(0, 6), min_size=40, max_size=40), min_size=1, max_size=4),
       st.integers(1, 6))
@settings(max_examples=60, deadline=None)
def test_best_positions_keep_all_of_the_best(columns, k):
    """Every document at or above the k-th score is returned, whatever the ties."""
    lists = []
    for c in columns:
        impacts = np.array(c, dtype=np.int64)
        entries = np.flatnonzero(impacts)
        lists.append(lexical.ImpactList(entries, impacts[entries]))
    docs, scores, _ = lexical.best_positions(lists, 40, k)
    total = np.sum(np.array(columns), axis=0)
    best = sorted((-s, d) for d, s in enumerate(total) if s > 0)[:k]
    assert sorted((-s, d) for d, s in zip(docs.tolist(), scores.tolist()))[:k] == best


def test_stops_before_the_end_of_the_lists():
    """Direct accesses push best positions on: fewer entries are read than the lists hold."""
    rng = np.random.default_rng(1)
    impacts = np.sort(rng.integers(1, 10**6, 20_000))[::-1].copy()
    lists = [lexical.ImpactList(np.arange(20_000), impacts + rng.integers(0, 50, 20_000)) for _ in range(3)]
    _, _, read = lexical.best_positions(lists, 20_000, 10)
    assert read < 3 * 2_000


def test_extra_columns_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "cat", "x", 5)], "doc_id long, text string, `a.b` string, score int")
    i = spark.createDataFrame([(7, "cat", 3)], "item_id int, text string, rank int")
    none = d.limit(0)
    assert [tuple(r)[:3] for r in lexical.rank(d, i).collect()] == [(7, 1, 1)]
    assert lexical.rank(none, i).count() == 0
    assert lexical.rank(d, i.limit(0)).count() == 0
