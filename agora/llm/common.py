"""Small helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.session import ensure_checkpoint_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


BATCH_BYTES = "8m"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` for this session, unless it sets its own size.

    Rows are whole texts: a batch is held by the JVM, the worker and its results at once.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "64m", "67108864"):          # Spark's default
        spark.conf.set(key, BATCH_BYTES)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (NULL: empty); other columns are not read."""
    bound_batches(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def remainder(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; the text of a NULL id is empty."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared checkpoint folder."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_to_unique(many: DataFrame, one: DataFrame, on: list[str], weight: str, spread: Column,
                   how: str = "inner", salts: int = 16, hot: int = 1000) -> DataFrame:
    """``many`` joined to ``one``, which is unique on the columns ``on`` and is read twice.

    ``weight`` counts a key's rows in ``many``. Keys with at least 1/``hot`` of
    the total weight (so at most ``hot`` of them, which are broadcast) are
    salted by ``spread``, a hash over ``many``; ``weight`` is dropped.
    """
    total = one.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * hot >= max(total, hot)
    salted = one.withColumn("_salt", F.explode(F.when(
        is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    keys = salted.filter(F.col("_salt") == 1).select(*on, F.lit(True).alias("_hot"))
    salt = F.when(F.col("_hot"), F.pmod(spread, F.lit(salts)).cast("int")).otherwise(0)
    return (many.join(F.broadcast(keys), on, "left").withColumn("_salt", salt).drop("_hot")
            .join(salted.drop(weight), [*on, "_salt"], how).drop("_salt"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``rows`` at a time: what a worker holds as Python objects stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, make: Callable[[], Callable[[dict], dict]],
                schema: pa.Schema, ddl: str) -> DataFrame:
    """``mapInArrow`` over columns as Python lists.

    ``make`` is called once per task and returns a function from a dict of
    lists (one per input column) to a dict of lists (one per output column).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in slices(batches):
            out = fn(batch.to_pydict())
            yield pa.RecordBatch.from_pydict(out, schema=schema)
    return df.mapInArrow(run, ddl)


# Base of the word hash, a random table of byte values, their seed.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
_WHITE = bytes(b in b" \t\n\x0b\x0c\r" for b in range(256))
_POWERS_KEPT = 1 << 20                  # powers a process keeps; a longer text's are made for it
_kept_powers = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    global _kept_powers
    if n > len(_kept_powers[0]):
        size = n if n > _POWERS_KEPT else min(_POWERS_KEPT, 2 * n)
        made = []
        for base in (int(_BASE), pow(int(_BASE), -1, 2**64)):
            power = np.full(size, base, dtype=np.uint64)
            power[0] = 1
            made.append(np.cumprod(power, out=power))
        if size > _POWERS_KEPT:
            return made[0], made[1]
        _kept_powers = (made[0], made[1])
    return _kept_powers[0][:n], _kept_powers[1][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs without ASCII white space) and the words of each text.

    A word's hash is a polynomial over the random values of its bytes, from
    prefix sums over all texts at once, then mixed with its length.
    """
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    joined = b"\n".join([*texts, b""])
    data = np.frombuffer(joined, dtype=np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    white = np.frombuffer(joined.translate(_WHITE), dtype=bool)
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]           # the data ends with white space
    lengths = (ends - starts).astype(np.uint64)
    power, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    terms = _BYTE[data]
    terms *= power
    np.cumsum(terms, out=sums[1:])
    # divided by the power at its start, a word's sum does not depend on its place
    h = (sums[ends] - sums[starts]) * inverse[starts]
    h = (h ^ (h >> np.uint64(32)) ^ lengths) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    bounds = np.cumsum(sizes + 1)
    return h, np.diff(np.searchsorted(starts, bounds), prepend=0)


class Memo(dict):
    """Values of a pure function, two generations deep and bounded.

    A full young generation becomes the old one; what is still asked for moves
    back up, so frequent keys stay.
    """

    def __init__(self, compute: Callable, entries: int):
        super().__init__()
        self.compute, self.entries, self.old = compute, entries, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value

    def rest(self) -> None:
        """To be called between texts: starts a new generation when this one is full."""
        if len(self) > self.entries:
            self.old = dict(self)
            self.clear()
