from __future__ import annotations

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as cp
from agora.llm import bpe, quality_mil
from agora.llm.common import documents, written
from agora.llm.queries import quality_model
from tests.llm.test_decontaminate import brute as overlaps
from tests.llm.test_pii import brute as spans

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark):
    """Input and output rows of every stage."""
    out, docs = [], documents(spark, SF)
    for name, stage in cp.STAGES:
        after = written(stage(spark, docs, SF))
        out.append((docs.toPandas(), after.toPandas()))
        docs = after
    return out


def shingle_set(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def test_stages():
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "n-gram Jaccard join",
                                         "benchmark decontamination", "PII", "byte-level BPE"]


def test_columns(spark, results):
    want = documents(spark, SF).columns
    assert all(list(after.columns) == want for _, after in results[:-1])


def test_quality(spark, results):
    before, after = results[0]
    model = quality_model(documents(spark, SF), spark, SF)
    good = model.score([quality_mil.encode(t or "") for t in before.text]) >= 0.7
    assert sorted(after.doc_id) == sorted(before.doc_id[good])
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    kept = [labels[i] for i in before.doc_id if i in labels.index and i in set(after.doc_id)]
    gone = [labels[i] for i in before.doc_id if i in labels.index and i not in set(after.doc_id)]
    assert np.mean(kept) > 0.97 and np.mean(gone) < 0.1


def test_near_duplicates(results):
    before, after = results[1]
    rows = sorted(zip(before.doc_id, map(shingle_set, before.text)))
    holders, root = {}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    sets = dict(rows)
    for i, s in rows:
        near = {j for x in s for j in holders.get(x, ())}
        for j in near:
            common = len(s & sets[j])
            if 100 * common >= 80 * (len(s) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for x in s:
            holders.setdefault(x, []).append(i)
    assert sorted(after.doc_id) == sorted(i for i in root if root[i] == i)
    assert len(after) < len(before)


def test_decontamination(spark, results):
    before, after = results[2]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    tokens = {w for _, t in bench for w in re.findall(r"[^\W_]+", t.lower())}
    few = [(i, t) for i, t in zip(before.doc_id, before.text)
           if len(tokens.intersection(re.findall(r"[^\W_]+", t.lower()))) > 5 and len(t) < 3000]
    bad = {i for i, _ in overlaps(few, bench)}
    gone = set(before.doc_id) - set(after.doc_id)
    assert bad == gone & {i for i, _ in few} and gone


def test_personal_data(results):
    before, after = results[3]
    new = dict(zip(after.doc_id, after.text))
    assert sorted(before.doc_id) == sorted(after.doc_id)
    changed = 0
    for i, text in zip(before.doc_id, before.text):
        found = spans(text)
        if not found:
            assert new[i] == text
        else:
            changed += 1
            assert not spans(new[i]) and new[i] != text
    assert changed > 10
    assert (after.text.str.len() == after.n_chars).all()


def test_tokens(results):
    before, after = results[4]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ref = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                            special_tokens={})
    texts = dict(zip(before.doc_id, before.text))
    assert sorted(after.doc_id) == sorted(before.doc_id)
    for r in after.itertuples():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == ref.encode_ordinary(texts[r.doc_id]) and len(ids) == r.n_tokens
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
