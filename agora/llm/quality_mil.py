"""Quality classifier: gated attention over passages (multiple-instance learning).

A document is a bag of passages of 64 words; only the document has a label.
Every passage is encoded (surface measures, then a learned layer h), a gated
attention unit weighs it,

    a_k = softmax_k( w . (tanh(V h_k) * sigmoid(U h_k)) ),

and the label is predicted from the weighted representation sum_k a_k h_k.

Fitting: at most ``sample_docs`` labelled documents, the first by a hash of
their id, each with all its passages (a few numbers each). Scoring reads
every passage of every document where the document lies; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.common import bound_batches, id_text, map_batches

PASSAGE_WORDS = 64
FEATURES = ("words", "mean_len", "dev_len", "max_len", "distinct", "distinct_pairs", "upper",
            "digits", "marks", "shouts", "symbols", "others", "lines", "short")
# Character classes: 0 white space, 1 lower and other letters, 2 upper, 3 digits,
# 4 marks, 5 exclamation marks, 6 symbols, 7 others, 8 line feeds.
_CLASS = None


def _classes() -> np.ndarray:
    """Class of every code point of the basic plane, built once per process."""
    global _CLASS
    if _CLASS is None:
        table = np.full(65536, 7, dtype=np.int8)
        for i in range(65536):
            ch = chr(i)
            if ch.isspace():
                table[i] = 0
            elif ch.isupper():
                table[i] = 2
            elif ch.isalpha():
                table[i] = 1
            elif ch.isdigit():
                table[i] = 3
        for ch in ".,;:?'\"-()":
            table[ord(ch)] = 4
        table[ord("!")] = 5
        for ch in "#*$%&|<>~^=_/\\+@[]{}`":
            table[ord(ch)] = 6
        table[10] = 8
        _CLASS = table
    return _CLASS


def encode(text: str) -> np.ndarray:
    """Measures of every passage, passages x FEATURES; an empty text is one passage of zeros."""
    words = text.split()
    if not words:
        return np.zeros((1, len(FEATURES)))
    n = -(-len(words) // PASSAGE_WORDS)
    starts = np.arange(n) * PASSAGE_WORDS
    lens = np.fromiter(map(len, words), dtype=np.float64, count=len(words))
    count = np.minimum(PASSAGE_WORDS, len(words) - starts)
    mean = np.add.reduceat(lens, starts) / count
    dev = np.sqrt(np.maximum(0, np.add.reduceat(lens * lens, starts) / count - mean * mean))
    # a character belongs to the passage of the last word that began before it
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    kind = _classes()[np.minimum(codes, 65535)].astype(np.int64)
    white = (kind == 0) | (kind == 8)
    begins = ~white & np.concatenate(([True], white[:-1]))
    word = np.maximum(np.cumsum(begins) - 1, 0)
    by = np.bincount(np.minimum(word // PASSAGE_WORDS, n - 1) * 9 + kind, minlength=9 * n)
    by = by.reshape(n, 9).astype(np.float64)
    solid = np.maximum(1, by[:, 1:8].sum(axis=1))
    letters = np.maximum(1, by[:, 1] + by[:, 2])
    distinct, pairs = np.empty(n), np.empty(n)
    for k in range(n):
        part = words[k * PASSAGE_WORDS:(k + 1) * PASSAGE_WORDS]
        distinct[k] = len(set(part)) / len(part)
        pairs[k] = len(set(zip(part, part[1:]))) / max(1, len(part) - 1) if len(part) > 1 else 1.0
    return np.column_stack([
        count / PASSAGE_WORDS, mean / 10, dev / 10,
        np.minimum(np.maximum.reduceat(lens, starts), 60) / 30, distinct, pairs,
        by[:, 2] / letters, by[:, 3] / solid, by[:, 4] / solid, by[:, 5] / solid, by[:, 6] / solid,
        by[:, 7] / solid, np.minimum(1, by[:, 8] / count * 4),
        np.add.reduceat((lens <= 3).astype(np.float64), starts) / count])


@dataclass
class Model:
    """Parameters; ``prior`` alone is used when there was nothing to learn from."""
    prior: float
    shift: np.ndarray | None = None
    scale: np.ndarray | None = None
    p: dict | None = None

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.p is None or not bags:
            return np.full(len(bags), self.prior)
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        x = (np.concatenate(bags) - self.shift) / self.scale
        return _sigmoid(_forward(self.p, x, starts)[-1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(p: dict, x: np.ndarray, starts: np.ndarray) -> tuple:
    sizes = np.diff(np.append(starts, len(x)))
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * g) @ p["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(h * a[:, None], starts)
    return h, t, g, a, z, z @ p["c"] + p["d"]


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 16, gate: int = 8,
        epochs: int = 60, batch: int = 256, rate: float = 0.01, decay: float = 1e-4,
        seed: int = 7) -> Model:
    """Adam on the cross entropy of the bags' labels; the same input gives the same model."""
    y = np.asarray(labels, dtype=np.float64)
    prior = float(y.mean()) if len(y) else 0.5
    if len(set(y.tolist())) < 2:
        return Model(prior)
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    shift, scale = every.mean(axis=0), np.maximum(every.std(axis=0), 1e-3)
    bags = [(b - shift) / scale for b in bags]
    d = every.shape[1]
    p = {"W": rng.normal(0, d ** -0.5, (d, hidden)), "b": np.zeros(hidden),
         "V": rng.normal(0, hidden ** -0.5, (hidden, gate)),
         "U": rng.normal(0, hidden ** -0.5, (hidden, gate)),
         "w": rng.normal(0, gate ** -0.5, gate), "c": rng.normal(0, hidden ** -0.5, hidden),
         "d": np.zeros(1)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            part = [bags[i] for i in pick]
            sizes = np.array([len(b) for b in part])
            starts = np.cumsum(np.append(0, sizes))[:-1]
            x = np.concatenate(part)
            h, t, g, a, z, s = _forward(p, x, starts)
            ds = (_sigmoid(s) - y[pick]) / len(pick)
            dz = np.repeat(ds[:, None] * p["c"], sizes, axis=0)
            da = (dz * h).sum(axis=1)
            mean = np.repeat(np.add.reduceat(da * a, starts), sizes)
            de = a * (da - mean)
            dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
            dh = dz * a[:, None] + dt @ p["V"].T + dg @ p["U"].T
            dx = dh * (1 - h * h)
            grads = {"W": x.T @ dx, "b": dx.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg,
                     "w": (t * g).T @ de, "c": z.T @ ds, "d": np.array([ds.sum()])}
            step += 1
            for k in p:
                grad = grads[k] + decay * p[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                v2[k] = 0.999 * v2[k] + 0.001 * grad * grad
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(prior, shift, scale, p)


def learn(docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "quality",
          sample_docs: int = 6000, id_col: str = "doc_id",
          text_col: str = "text") -> Model:
    """A model of the labelled documents for which ``usable`` (over column ``doc_id``) holds.

    Several labels of one document count as their rounded mean; NULL labels
    and ids are left out.
    """
    marks = (labels.select(labels[id_col].cast("long").alias("doc_id"),
                           labels[label_col].cast("double").alias("y"))
             .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull()).filter(usable)
             .groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs))
    # at most sample_docs rows of two numbers
    rows = id_text(docs, id_col, text_col).join(F.broadcast(marks), "doc_id")

    def make():
        def run(cols):
            out = []
            for text in cols["text"]:
                out.append(encode(text).astype("<f4").tobytes())
            return {"doc_id": cols["doc_id"], "y": cols["y"], "x": out}
        return run
    sample = map_batches(rows.select("doc_id", "text", "y"), make, pa.schema(
        [("doc_id", pa.int64()), ("y", pa.int32()), ("x", pa.binary())]),
        "doc_id long, y int, x binary").orderBy(
        F.xxhash64("doc_id"), "doc_id", "x").limit(sample_docs).collect()
    bags = [np.frombuffer(r.x, dtype="<f4").reshape(-1, len(FEATURES)).astype(np.float64)
            for r in sample]
    return fit(bags, np.array([r.y for r in sample]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
          ) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``n_passages`` of every whole text, one row per row.

    NULL text is empty text, which is one passage without words. Repeated
    rows and NULL ids are kept as they are; empty tables give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        fitted = shared.value

        def run(cols):
            scores, sizes = [], []
            for at in range(0, len(cols["text"]), 256):
                bags = [encode(t) for t in cols["text"][at:at + 256]]
                scores += fitted.score(bags).tolist()
                sizes += map(len, bags)
            return {"doc_id": cols["doc_id"], "score": scores, "n_passages": sizes}
        return run
    return map_batches(id_text(docs, id_col, text_col), make, pa.schema(
        [("doc_id", pa.int64()), ("score", pa.float64()), ("n_passages", pa.int64())]),
        "doc_id long, score double, n_passages long")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text"
              ) -> DataFrame:
    """The rows of ``docs`` scored at ``threshold`` or above; all columns as they are.

    NULL text is empty text; repeated rows share their score; an empty table keeps none.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def quality(texts):
        import pandas as pd
        scores = []
        for at in range(0, len(texts), 256):
            scores += shared.value.score([encode(t or "") for t in texts.iloc[at:at + 256]]).tolist()
        return pd.Series(scores, dtype="float64")
    return docs.filter(quality(F.coalesce(docs[text_col].cast("string"), F.lit(""))) >= threshold)
