import numpy as np
import pytest
from pyspark.sql import functions as F

from agora.llm import langid
from agora.llm.common import documents, remainder
from agora.llm.queries import op13_langid

SF = "/root/testdata/sf0.01"


def slow_counts(text):
    """Buckets of the two- and three-byte grams, one gram at a time."""
    data = " " + "".join(c if ord(c) > 127 or "a" <= c <= "z" else " " for c in text.lower()) + " "
    data = data.encode()
    out = np.zeros(langid.DIM, dtype=np.int64)
    for n, factor in ((2, 0x9E3779B1), (3, 0x85EBCA6B)):
        for i in range(len(data) - n + 1):
            gram = data[i:i + n]
            if gram.strip(b" "):
                code = int.from_bytes(gram, "big")
                out[(code * factor % 2**32) >> 19] += 1
    return out


@pytest.mark.parametrize("text", ["", "a", "Straße, 12 Äpfel!", "\x00 x\ny", "漢字 kanji", "ab" * 50])
def test_counts_by_definition(text, monkeypatch):
    assert (langid.counts(text) == slow_counts(text)).all()
    monkeypatch.setattr(langid, "PIECE", 7)                  # pieces change nothing
    assert (langid.counts(text) == slow_counts(text)).all()


def test_weights_and_nearest_centroid_by_brute_force(spark):
    docs = documents(spark, SF)
    train = remainder(F.col("doc_id"), 3) != 1
    model = langid.learn(docs, train)
    texts = [r[0] for r in docs.filter(train & F.col("lang").isNotNull()).select("text").collect()
             if r[0] is not None]
    df = np.sum([langid.counts(t) > 0 for t in texts], axis=0)
    assert np.allclose(model.idf, np.log((1 + len(texts)) / (1 + df)) + 0.1)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for r in docs.limit(200).collect():
        v = np.sqrt(langid.counts(r.text or "")) * model.idf
        cosines = {}
        for lang, c in zip(model.languages, model.centroids):
            cosines.setdefault(lang, []).append(float(np.dot(v, c) / max(np.linalg.norm(v), 1e-12)))
        if langid.has_letter(r.text):
            best = max(max(c) for c in cosines.values())
            assert got[r.doc_id].score == pytest.approx(best, abs=1e-4)
            assert max(cosines[got[r.doc_id].lang_pred]) == pytest.approx(best, abs=1e-5)


def test_held_out_accuracy(spark):
    rows = (op13_langid(spark, SF).join(documents(spark, SF).select("doc_id", "lang"), "doc_id")
            .filter("held_out AND lang_pred <> 'und'"))
    share, n = rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and share > 0.97


def test_several_centroids_and_rejection(spark):
    model = langid.learn(documents(spark, SF), remainder(F.col("doc_id"), 3) != 1)
    assert all(model.languages.count(lang) > 1 for lang in set(model.languages))
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-5)
    lang, score, far = model.nearest("жжж ъъъ щщщ " * 30)     # no learned script
    assert lang in model.languages and far and score < 0.2
    text = documents(spark, SF).filter("length(text) > 500").first().text
    assert not model.nearest(text)[2]


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, "le chat et le chien", "fr", 1), (2, "the dog and the cat", "en", 1), (3, None, "en", 1),
         (4, "", "fr", 1), (5, "123 ½ ²!", "en", 1), (None, "the cat", "en", 1), (7, "ñ", None, 1),
         (1, "le chat et le chien", "fr", 1), (8, "the dog " * 400_000, "en", 1)],
        "doc_id long, text string, lang string, `lang.x` int")
    model = langid.learn(docs, F.lit(True))
    got = langid.predict(docs, model).collect()
    assert len(got) == 9
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3, 4, 5, None, 8)] == \
        ["fr", "en", "und", "und", "und", "en", "en"]
    assert by[7].lang_pred in ("fr", "en") and by[3].score == 0
    assert all(0 <= r.score <= 1 for r in got)
    none = langid.learn(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        langid.learn(docs, F.lit(True), languages=1)


def test_sample_is_bounded_and_the_same_however_rows_are_dealt(spark):
    docs = documents(spark, SF).filter("lang IS NOT NULL")
    a = langid._sample(docs, 20)
    b = langid._sample(docs.repartition(7), 20)
    assert a.groupBy("lang").count().agg(F.max("count")).first()[0] == 20
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
