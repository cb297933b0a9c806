"""Ranked lexical search by the Best Position Algorithm over impact lists.

``build`` writes an index: documents are gathered into shards of bounded size
inside the task that reads them, and every term of a shard is one row, its
list of (document, occurrences). Nothing is shuffled, and a term that is in
every document is one bounded row per shard.

``search`` scores all documents for each item. A shard turns the lists of the
items' terms into impact lists (highest share of the score first) and runs the
Best Position Algorithm for each item:

* sorted access reads the next entries of all lists; every document met for
  the first time is looked up in all the other lists (direct access), which
  gives its whole score and marks its position in each list as seen;
* the best position of a list is the end of its unbroken run of seen positions,
  which direct accesses push beyond the last position read;
* a document not seen yet lies behind every best position, so the sum of the
  impacts that follow them bounds its score. The shard stops when this bound
  is strictly below the k-th score (at equality a smaller id could still enter).

The shards of a first part (one in ``FIRST``) give a score that k documents are
known to reach; the other shards may stop below it too. The k best of a shard
hold all it adds to the k best of the whole, so the rows merged are at most k
per shard and item, and the result is exact.

Items are taken in blocks of bounded size (``BLOCK_TERMS``), each block in one
pass over the index; a block's terms and weights are what is broadcast.

Every row of the documents is a document and every row of the items an item,
repeated rows too. NULL texts have no terms; an item without terms, or whose
terms no document holds, has no rows. NULL doc_ids rank after all other ids
at equal scores; equal rows share their score and take consecutive ranks.
Empty tables give no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import written

SHARD_DOCS = 16_384                     # documents in a shard (an entry's number has 16 bits)
SHARD_BYTES = 32_000_000                # text in a shard
BLOCK_TERMS = 200_000                   # terms (with repeats) of the items handled at a time
FIRST = 16                              # one shard in so many gives the first bound

# Characters of a term are digits, letters and all that is not ASCII;
# A-Z are lowered and any other character separates.
_TABLE = bytes(b + 32 if 65 <= b <= 90
               else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127
               else 32 for b in range(256))

_INDEX = pa.schema([("shard", pa.int64()), ("term", pa.binary()), ("docs", pa.int64()),
                    ("total", pa.int64()), ("entries", pa.binary()), ("counts", pa.binary()),
                    ("nulls", pa.binary())])
_INDEX_DDL = ("shard long, term binary, docs long, total long, entries binary, counts binary, "
              "nulls binary")
_FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "item int, doc_id long, score long"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, with repeats (UTF-8)."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


# ---------------------------------------------------------------- index

class _Shard:
    """Lists of the documents gathered so far."""

    def __init__(self):
        self.ids, self.sizes, self.bytes = [], array("q"), 0
        self.entries = defaultdict(lambda: array("H"))
        self.counts = defaultdict(lambda: array("I"))

    def add(self, doc_id: int | None, text: str | None) -> None:
        number, found = len(self.ids), terms(text)
        for term, tf in Counter(found).items():
            self.entries[term].append(number)
            self.counts[term].append(tf)
        self.ids.append(doc_id)
        self.sizes.append(len(found))
        self.bytes += len(text or "")

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        ids = np.array([i or 0 for i in self.ids], dtype=np.int64)
        nulls = np.array([i is None for i in self.ids], dtype=bool)
        yield pa.RecordBatch.from_pydict({
            "shard": [shard], "term": [None], "docs": [sum(n > 0 for n in self.sizes)],
            "total": [sum(self.sizes)], "entries": [ids.tobytes()],
            "counts": [self.sizes.tobytes()], "nulls": [nulls.tobytes()]}, schema=_INDEX)
        names = sorted(self.entries)
        for at in range(0, len(names), 2000):
            part = names[at:at + 2000]
            yield pa.RecordBatch.from_pydict({
                "shard": [shard] * len(part), "term": part,
                "docs": [len(self.entries[t]) for t in part],
                "total": [0] * len(part),
                "entries": [self.entries[t].tobytes() for t in part],
                "counts": [self.counts[t].tobytes() for t in part],
                "nulls": [None] * len(part)}, schema=_INDEX)


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all documents, a table in the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, shard = TaskContext.get().partitionId(), 0, _Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                shard.add(doc_id.as_py(), text.as_py())
                if len(shard.ids) >= SHARD_DOCS or shard.bytes >= SHARD_BYTES:
                    yield from shard.rows((task << 24) + made)
                    made, shard = made + 1, _Shard()
        if shard.ids:
            yield from shard.rows((task << 24) + made)
    narrow = docs.select(docs[id_col].cast("long"), docs[text_col].cast("string"))
    return written(narrow.mapInArrow(run, _INDEX_DDL))


# ---------------------------------------------------------------- one shard

class ImpactList:
    """One term's entries in a shard: by document, and by impact (highest first)."""

    def __init__(self, entries: np.ndarray, impacts: np.ndarray):
        self.entries, self.impacts = entries, impacts
        order = np.argsort(-impacts, kind="stable")
        self.by_impact = entries[order]
        self.descending = np.append(impacts[order], 0)       # nothing follows the last
        self.position = np.empty(len(order), dtype=np.int32)
        self.position[order] = np.arange(len(order), dtype=np.int32)


def best_positions(lists: list[ImpactList], documents: int, k: int,
                   bound: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents and whole scores, among them the k best with all ties; also the entries read.

    ``bound`` is a score that k documents elsewhere are known to reach: documents
    strictly below it may be left out.
    """
    met = np.zeros(documents, dtype=bool)
    seen = [np.zeros(len(x.by_impact) + 1, dtype=bool) for x in lists]  # the last stays False
    best = [0] * len(lists)
    docs, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    depth, step, read = 0, 32, 0
    while True:
        fresh = np.concatenate([x.by_impact[depth:depth + step] for x in lists])
        read += len(fresh)
        fresh = np.unique(fresh[~met[fresh]])
        met[fresh] = True
        whole = np.zeros(len(fresh), dtype=np.int64)
        threshold = 0
        for i, x in enumerate(lists):
            if len(fresh):
                at = np.searchsorted(x.entries, fresh)
                at[at == len(x.entries)] = 0
                hit = x.entries[at] == fresh
                at = at[hit]
                whole[hit] += x.impacts[at]
                seen[i][x.position[at]] = True
            best[i] += int(np.argmin(seen[i][best[i]:]))     # the first position not seen
            threshold += int(x.descending[best[i]])
        docs, scores = np.concatenate((docs, fresh)), np.concatenate((scores, whole))
        kth = 0
        if len(scores) >= k:
            kth = int(np.partition(scores, len(scores) - k)[len(scores) - k])
            keep = scores >= kth
            docs, scores = docs[keep], scores[keep]
        if threshold < max(kth, bound) or threshold == 0:
            keep = scores >= max(kth, bound, 1)
            return docs[keep], scores[keep], read
        depth, step = depth + step, min(2 * step, 4096)


def _search_shard(table: pa.Table, items: list[list[int]], weights: list[int],
                  numbers: dict[bytes, int], documents: int, total: int, k: int,
                  bounds: list[int]) -> pa.Table:
    """The best k of one shard for every item of a block."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["term"] is None)
    ids = np.frombuffer(head["entries"], dtype=np.int64)
    nulls = np.frombuffer(head["nulls"], dtype=bool)
    sizes = np.frombuffer(head["counts"], dtype=np.int64)
    lengths = 100 - 50 + (50 * sizes * documents) // max(total, 1)
    lists = {}
    for r in rows:
        if r["term"] is not None:
            number = numbers[r["term"]]
            entries = np.frombuffer(r["entries"], dtype=np.uint16).astype(np.int64)
            tf = np.frombuffer(r["counts"], dtype=np.uint32).astype(np.int64)
            share = (1_000_000_000 * tf) // (1000 * tf + 20 * lengths[entries])
            lists[number] = ImpactList(entries, weights[number] * share)
    del rows
    out: tuple[list, list, list] = ([], [], [])
    for item, own in enumerate(items):
        mine = [lists[t] for t in own if t in lists]
        if not mine:
            continue
        docs, scores, _ = best_positions(mine, len(ids), k, bounds[item])
        order = np.lexsort((ids[docs], nulls[docs], -scores))[:k]
        out[0].append(np.full(len(order), item, dtype=np.int32))
        out[1].append(pa.array(ids[docs[order]], mask=nulls[docs[order]]))
        out[2].append(scores[order])
    if not out[0]:
        return _FOUND.empty_table()
    return pa.table([pa.array(np.concatenate(out[0])), pa.concat_arrays(out[1]),
                     pa.array(np.concatenate(out[2]))], schema=_FOUND)


# ---------------------------------------------------------------- all shards

def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """(id, distinct terms) of the items, in blocks of about BLOCK_TERMS terms."""
    block, size = [], 0
    for row in items.select(id_col, F.col(text_col).cast("string")).toLocalIterator():
        own = sorted(set(terms(row[1])))
        if block and size + len(own) > BLOCK_TERMS:
            yield block
            block, size = [], 0
        block.append((row[0], own))
        size += len(own)
    if block:
        yield block


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order).cast("int"))
            .filter(F.col("rank") <= k))


def search(index: DataFrame, items: DataFrame, k: int = 50, id_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of each item with a score above 0."""
    spark = index.sparkSession
    whole = index.filter("term IS NULL").agg(F.sum("docs"), F.sum("total")).first()
    documents, total = whole[0] or 0, whole[1] or 0
    id_type = items.schema[id_col].dataType
    out = spark.createDataFrame([], f"item_id {id_type.simpleString()}, rank int, doc_id long, score long")
    for block in _blocks(items, id_col, text_col):
        names = sorted({t for _, own in block for t in own})
        if not names or not documents:
            continue
        vocabulary = spark.createDataFrame([(t,) for t in names], "term binary")
        # bounded by BLOCK_TERMS, as are the document frequencies that come back
        lists = index.join(F.broadcast(vocabulary), "term")
        df = {bytes(r[0]): r[1] for r in lists.groupBy("term").agg(F.sum("docs")).collect()}
        numbers = {t: i for i, t in enumerate(names)}
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(t, 0) + 1)))
                   for t in names]
        wanted = [[numbers[t] for t in own if t in df] for _, own in block]
        parts = lists.select(index.columns).unionByName(index.filter("term IS NULL"))

        def found(part: DataFrame, bounds: list[int]) -> DataFrame:
            def run(table: pa.Table) -> pa.Table:
                return _search_shard(table, wanted, weights, numbers, documents, total, k, bounds)
            return part.groupBy("shard").applyInArrow(run, _FOUND_DDL)

        is_first = F.pmod(F.xxhash64("shard"), F.lit(FIRST)) == 0
        first = written(_best(found(parts.filter(is_first), [0] * len(block)), k).drop("rank"))
        bounds = [0] * len(block)
        for r in first.groupBy("item").agg(F.count("*"), F.min("score")).collect():
            if r[1] == k:
                bounds[r[0]] = r[2]
        rest = found(parts.filter(~is_first), bounds)
        ranked = _best(first.unionByName(rest), k)
        ids = spark.createDataFrame([(i, row[0]) for i, row in enumerate(block)],
                                    f"item int, item_id {id_type.simpleString()}")
        out = out.unionByName(ranked.join(F.broadcast(ids), "item")
                              .select("item_id", "rank", "doc_id", "score"))
    return out


def rank(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The k best documents of each item: the index built and searched."""
    return search(build(docs), items, k)


SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM len),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, whole WHERE term IN (SELECT term FROM item_terms) GROUP BY term, n_docs),
scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))::BIGINT
           AS score
  FROM item_terms JOIN weight USING (term) JOIN tf USING (term) JOIN len USING (doc_id), whole
  GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0) ranked
WHERE rank <= 50
"""
