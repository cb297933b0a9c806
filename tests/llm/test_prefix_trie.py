import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from agora.llm import prefix_trie
from agora.llm.common import remainder

DDL = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes of the rebuilt conversations, from a dictionary of prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, sha, (role, text)))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        convs[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        leaves = [q for q in below if not any(len(r) > len(q) and r[:len(q)] == q for r in below)]
        ends = sorted(c for c in m if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m),
                    sum(len(q) == len(p) + 1 for q in below), len(leaves),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, parts=None):
    df = spark.createDataFrame(rows, DDL)
    conv = F.col("conv_id")
    out = prefix_trie.trie(df, conv - conv % 100, remainder(conv, 6), parts)
    return sorted((tuple(r) for r in out.collect()), key=str)


def random_rows(seed, convs, turns, words):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(400, convs, replace=False):
        for t in range(int(rng.integers(0, turns + 1))):
            rows.append((int(c), t, "u" if t % 2 else "a", "x" * int(rng.integers(words))))
    return rows


@pytest.mark.parametrize("seed,turns,words", [(1, 4, 2), (2, 9, 2), (3, 6, 1), (4, 5, 40), (5, 12, 3)])
@pytest.mark.parametrize("parts", [1, 3, 16])
def test_equals_brute_force(spark, seed, turns, words, parts):
    rows = random_rows(seed, 60, turns, words)
    assert found(spark, rows, parts) == brute(rows)


def test_copies_over_many_partitions(spark, monkeypatch):
    """One group of equal conversations in most partitions: its ids are hashed in order."""
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, t, "u", f"hello {t}") for c in range(300) for t in range(8)]
    rows += [(c, t, "u", f"other {c % 3}") for c in range(300, 330) for t in range(7)]
    assert found(spark, rows, 12) == brute(rows)


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [(100, None, None, None), (100, 0, "u", "hi"), (100, 0, "u", "hi"), (100, 0, "a", "hi"),
            (101, 1, "", ""), (None, 0, "u", "lost"), (103, 5, "u", "héé 漢"), (205, 0, "u", "no base"),
            (104, -3, "u", None), (104, 0, "u", "hi"), (7, 0, "1:u", "x"), (8, 0, "1", "u:x")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, 5) == brute(rows)


def test_empty_and_extra_columns(spark):
    assert found(spark, [(None, 0, "u", "x")]) == []
    assert found(spark, []) == []
    df = spark.createDataFrame([(1, 0, "u", "x", 9, "k")], DDL + ", depth int, `key.t` string")
    conv = F.col("conv_id")
    assert prefix_trie.trie(df, conv - conv % 100, remainder(conv, 6)).count() >= 1


def test_contracted_forests_keep_what_crosses():
    run = [prefix_trie.Run(1, i, 0, 0, 9, 1) for i in range(6)]
    edges = [prefix_trie.Edge(lcp, lcp) for lcp in (1, 3, 1, 2, 5)]
    kept, between = prefix_trie.contract(run, edges)
    assert [(e.lcp, e.count) for e in between] == [(1, 2), (2, 1), (5, 1)]
    assert [r.n for r in kept] == [3, 1, 1, 1]
    kept, between = prefix_trie.mirrored(run, edges)
    assert [(e.lcp, e.count) for e in between] == [(1, 2)]
    assert [r.n for r in kept] == [1, 5]
