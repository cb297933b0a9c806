"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text's vector counts its byte n-grams (two and three bytes of the lowered
UTF-8 text, ASCII other than letters read as a space), each in one of ``DIM``
buckets by a fixed hash; counts are damped, weighted by the inverse document
frequency of the training documents and scaled to length 1. Every language has
several centroids, found by clustering its sample by cosine (spherical
k-means), and a text takes the language of the nearest one. A text farther from
its nearest centroid than that centroid's radius is marked as rejected: its
nearest language is still named, as no learned language fits better.

How it runs: document frequencies come from one pass over all training
documents (at most ``DIM`` sums per task, summed by Spark). Clusters are fitted
on at most ``SAMPLE`` documents a language, those of the least hashed ids; a
language's sample is one bounded group. What the driver holds and broadcasts is
``CLUSTERS`` vectors a language, for at most ``LANGUAGES`` languages (an error
beyond).

Texts are whole, whatever their length. NULL texts and texts without a letter
are ``und`` with score 0. Without a training document every text is ``und``.
NULL ids are kept (one document of the fit at most); repeated rows get equal
rows, and equally near centroids go to the language that sorts first. Only
the id, text and language columns are read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import slices

DIM = 8192                              # buckets of n-grams
SAMPLE = 1000                           # documents of a language that clusters are fitted on
PARTS = 64                              # parts that a language's least hashes are sought in
CLUSTERS = 4                            # centroids of a language, at most
LANGUAGES = 1000                        # languages a model may have
ROUNDS = 12                             # of the clustering
PIECE = 1 << 20                         # bytes of a text counted at a time
FAR = 1.5                               # a radius is so many times the distance of the 99th percentile
FEW = 10                                # documents below which a cluster has no radius of its own

UNKNOWN = "und"

# Multipliers of the bucket hash.
_TWO, _THREE = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_SHIFT = np.uint32(32 - 13)
_LOWER = bytes(b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def counts(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur in the text."""
    data = b" " + text.lower().encode("utf-8", "replace").translate(_LOWER) + b" "
    total = np.zeros(DIM, dtype=np.int64)
    for at in range(0, len(data) - 1, PIECE):
        a = np.frombuffer(data[at:at + PIECE + 2], dtype=np.uint8).astype(np.uint32)
        two = a[:-1] << np.uint32(8) | a[1:]
        three = two[:-1] << np.uint32(8) | a[2:]
        two = two[:PIECE][two[:PIECE] != 0x2020]
        three = three[:PIECE][three[:PIECE] != 0x202020]
        total += np.bincount(np.concatenate((two * _TWO, three * _THREE)) >> _SHIFT, minlength=DIM)
    return total


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    """The text's TF-IDF vector of length 1 (zero if no n-gram has a weight)."""
    v = (np.sqrt(counts(text)) * idf).astype(np.float32)
    size = np.linalg.norm(v)
    return v / size if size else v


@dataclass(frozen=True)
class Model:
    """Centroids (one row each) with their languages and radii, and the weights of the buckets."""
    languages: tuple[str, ...]
    centroids: np.ndarray
    radii: np.ndarray
    idf: np.ndarray

    def nearest(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine of its nearest centroid, rejected by distance)."""
        if not len(self.languages) or not has_letter(text):
            return UNKNOWN, 0.0, True
        cosine = self.centroids @ vector(text, self.idf)
        i = int(np.argmax(cosine))
        score = float(min(max(cosine[i], 0.0), 1.0))
        return self.languages[i], score, bool(1.0 - score > self.radii[i])


# ---------------------------------------------------------------- fitting

def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = np.zeros(DIM, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            held += counts(text.as_py()) > 0
            n += 1
    # bucket DIM counts the documents
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM + 1), pa.int32()),
                                      pa.array(np.append(held, n))], names=["bucket", "n"])


def inverse_frequencies(train: DataFrame) -> np.ndarray:
    """ln((1 + N) / (1 + df)) of every bucket, over all training texts (column ``text``)."""
    held = np.zeros(DIM + 1)
    for r in (train.select("text").mapInArrow(_frequencies, "bucket int, n long")
              .groupBy("bucket").agg(F.sum("n")).collect()):
        held[r[0]] = r[1]
    return np.log((1 + held[DIM]) / (1 + held[:DIM])) + 0.1


def _sample(train: DataFrame, size: int) -> DataFrame:
    """(lang, text) of the ``size`` least hashed ids of each language, one row an id."""
    keyed = train.withColumn("h", F.xxhash64("doc_id"))
    parts = keyed.select("lang", "h").distinct().withColumn("part", F.pmod("h", F.lit(PARTS)))
    # a language may hold most rows: the least of each part first, then of all parts
    for key in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*key).orderBy("h")
        parts = parts.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= size)
    cut = parts.groupBy("lang").agg(F.max("h").alias("cut"))
    return (keyed.join(F.broadcast(cut), "lang").filter("h <= cut")
            .groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text"))


def clusters(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids of length 1, radii) by spherical k-means.

    The rows, ordered along their widest direction, are cut into ``k`` equal
    parts to start from. A cluster of a few rows takes the radius of them all.
    """
    centred = vectors - vectors.mean(axis=0)
    along = centred[int(np.argmax(np.linalg.norm(centred, axis=1)))].astype(np.float64)
    for _ in range(10):                                      # power iteration
        along = centred.T @ (centred @ along)
        along /= max(np.linalg.norm(along), 1e-12)
    parts = np.array_split(np.argsort(centred @ along, kind="stable"), min(k, len(vectors)))
    centroids = _unit(np.stack([vectors[part].sum(axis=0) for part in parts]))
    for _ in range(ROUNDS):
        own = np.argmax(vectors @ centroids.T, axis=1)
        centroids = _unit(np.stack([vectors[own == j].sum(axis=0) if (own == j).any()
                                    else centroids[j] for j in range(len(centroids))]))
    cosine = vectors @ centroids.T
    own, distance = np.argmax(cosine, axis=1), 1 - cosine.max(axis=1)
    radii = [np.quantile(distance[own == j] if (own == j).sum() >= FEW else distance, 0.99)
             for j in range(len(centroids))]
    return centroids, FAR * np.maximum(radii, 0)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def learn(docs: DataFrame, train: Column, sample: int = SAMPLE, k: int = CLUSTERS,
          languages: int = LANGUAGES) -> Model:
    """A model of the rows of ``docs`` (doc_id, text, lang) that ``train`` marks and that have a lang."""
    spark = docs.sparkSession
    rows = (docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    F.col("lang").cast("string").alias("lang")))
    found = rows.select("lang").distinct().limit(languages + 1).count()
    if found > languages:
        raise ValueError(f"more than {languages} languages")
    idf = inverse_frequencies(rows)

    def fit(table: pa.Table) -> pa.Table:
        texts = sorted(t for t in table.column("text").to_pylist() if has_letter(t))
        if not texts:
            return pa.table({"lang": pa.array([], pa.string()), "centroid": pa.array([], pa.binary()),
                             "radius": pa.array([], pa.float64())})
        centroids, radii = clusters(np.stack([vector(t, idf) for t in texts]), k)
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(radii)),
                         "centroid": pa.array([c.astype(np.float32).tobytes() for c in centroids],
                                              pa.binary()),
                         "radius": pa.array(radii, pa.float64())})

    fitted = sorted(map(tuple, _sample(rows, sample).groupBy("lang").applyInArrow(
        fit, "lang string, centroid binary, radius double").collect()))
    centroids = (np.stack([np.frombuffer(bytes(c), dtype=np.float32) for _, c, _ in fitted])
                 if fitted else np.zeros((0, DIM), dtype=np.float32))
    return Model(tuple(r[0] for r in fitted), centroids, np.array([r[2] for r in fitted]), idf)


# ---------------------------------------------------------------- predicting

_PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()),
                        ("score", pa.float64()), ("rejected", pa.bool_())])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches):
            langs, scores, far = zip(*(own.nearest(t.as_py()) for t in batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs), pa.array(scores), pa.array(far)],
                schema=_PREDICTED)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
