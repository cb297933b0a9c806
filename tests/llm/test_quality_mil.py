from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from agora.llm import quality_mil as q
from agora.llm.common import remainder
from agora.llm.queries import op5_quality_mil

SF = "/root/testdata/sf0.01"


def prose(rng, n):
    return " ".join(rng.choice(["river", "stone", "quiet", "letters", "walks", "again", "winter",
                                "garden", "people", "morning"]) + rng.choice(["", "", "", ","])
                    for _ in range(n))


def fixture():
    rng = random.Random(2)
    rows = []
    for i in range(300):
        text, good = prose(rng, rng.randint(20, 300)), i % 2
        if not good:                       # one bad passage makes a document bad
            text += " " + " ".join(rng.choice("#$%|") * 3 for _ in range(64))
        rows.append((i, text, good))
    return rows


def test_learns_from_one_bad_passage():
    rows = fixture()
    bags, y = [q.encode(t) for _, t, _ in rows], np.array([g for *_, g in rows])
    model = q.fit(bags[:200], y[:200])
    assert ((model.score(bags[200:]) >= 0.5) == (y[200:] == 1)).mean() > 0.97
    again = q.fit(bags[:200], y[:200])
    assert np.array_equal(model.score(bags), again.score(bags))
    # a document's score does not depend on its neighbours
    assert np.allclose(model.score(bags[:5]), [model.score([b])[0] for b in bags[:5]])


def test_encode_edges():
    for text in ["", " \n\t ", "a", "a" * 100_000, "😀 你好\n" * 500, "퟿ x", "word " * 64]:
        x = q.encode(text)
        assert x.shape == (max(1, -(-len(text.split()) // 64)), len(q.FEATURES))
        assert np.isfinite(x).all()


def test_rows(spark):
    rows = fixture()
    docs = spark.createDataFrame([(i, t, "z") for i, t, _ in rows]
                                 + [(None, None, "z"), (500, "", "z"), (3, rows[3][1], "z")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, g) for i, _, g in rows] + [(None, 1), (9, None), (4, 0)],
                                   "doc_id long, quality int")
    model = q.learn(docs, labels, remainder(F.col("doc_id"), 4) != 2)
    got = q.score(docs, model).collect()
    assert len(got) == 303 and all(0 <= r.score <= 1 for r in got)
    held = [(r.score >= 0.5, rows[r.doc_id][2] == 1) for r in got
            if r.doc_id is not None and r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([a == b for a, b in held]) > 0.95
    kept = q.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in got if r.score >= 0.7)
    none = q.learn(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in q.score(docs, none).collect()} == {0.5}
    assert q.score(docs.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = op5_quality_mil(spark, SF)
    assert got.count() == 1000
    r = (got.filter("held_out").join(labels, "doc_id")
         .agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("right")).first())
    assert r.right > 0.93
