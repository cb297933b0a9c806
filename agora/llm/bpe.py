"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a minimal perfect hash over the vocabulary resolves a pre-token that
is itself a vocabulary entry. Tier 2: every other pre-token is merged byte by
byte, lowest rank first and leftmost on ties, with a heap over doubly linked
byte spans (O(n log n) in the pre-token's length, so a pre-token of megabytes
is no special case). Ranks of candidate merges come from a plain rank table.

The vocabulary (a rank file of fixed size) is read once on the driver and
broadcast; texts never leave their row, so there is no shuffle.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import Memo, id_text, map_batches

# Pre-tokens remembered per generation of a Python worker's memo.
MEMO_ENTRIES = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``base64 rank`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _h(key: bytes, seed: int, n: int) -> int:
    return xxhash.xxh3_64_intdigest(key, seed) % n


class PerfectHash:
    """Minimal perfect hash of fixed keys (hash and displace).

    A key's bucket holds either a seed that sends all the bucket's keys to
    free slots, or, for a bucket of one key, that key's slot as -slot - 1.
    ``get`` compares the key stored in the slot, so unknown keys give None.
    """

    def __init__(self, ranks: Mapping[bytes, int]):
        n = self.n = max(1, len(ranks))
        buckets: list[list[bytes]] = [[] for _ in range(n)]
        for key in ranks:
            buckets[_h(key, 0, n)].append(key)
        self.seeds = [0] * n
        self.keys: list[bytes | None] = [None] * n
        order = sorted(range(n), key=lambda b: -len(buckets[b]))
        singles = [b for b in order if len(buckets[b]) == 1]
        for b in order:
            if len(buckets[b]) < 2:
                break
            seed = 1
            while True:
                slots = [_h(key, seed, n) for key in buckets[b]]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    break
                seed += 1
            self.seeds[b] = seed
            for s, key in zip(slots, buckets[b]):
                self.keys[s] = key
        free = (s for s in range(n) if self.keys[s] is None)
        for b in singles:
            s = next(free)
            self.seeds[b] = -s - 1
            self.keys[s] = buckets[b][0]
        self.ranks = [ranks[k] if k is not None else -1 for k in self.keys]

    def rank_table(self) -> dict[bytes, int]:
        return {k: r for k, r in zip(self.keys, self.ranks) if k is not None}

    def get(self, key: bytes) -> int | None:
        seed = self.seeds[_h(key, 0, self.n)]
        slot = -seed - 1 if seed < 0 else _h(key, seed, self.n)
        return self.ranks[slot] if self.keys[slot] == key else None


def merge(piece: bytes, rank_of) -> list[int]:
    """Ids of one pre-token by repeated lowest-rank merges of adjacent spans."""
    n = len(piece)
    end = list(range(1, n + 1))          # end of the span that starts at i; 0: merged away
    before = list(range(-1, n - 1))      # start of the span left of i
    heap = []
    for i in range(n - 1):
        rank = rank_of(piece[i:i + 2])
        if rank is not None:
            heap.append((rank, i, i + 1, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if end[i] != mid or mid >= n or end[mid] != stop:
            continue                      # one of the two spans has changed since
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
            rank = rank_of(piece[i:end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, stop, end[stop]))
        left = before[i]
        if left >= 0:
            rank = rank_of(piece[left:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, left, i, stop))
    ids, i = [], 0
    while i < n:
        ids.append(rank_of(piece[i:end[i]]))
        i = end[i]
    return ids


class Encoder:
    """Text to ids as little-endian unsigned 32-bit integers."""

    def __init__(self, table: PerfectHash, pattern: str):
        self.whole = table.get
        self.rank_of = table.rank_table().get
        self.split = regex.compile(pattern).findall
        self.memo = Memo(self.pre_token, MEMO_ENTRIES)

    def pre_token(self, word: str) -> bytes:
        piece = word.encode("utf-8")
        rank = self.whole(piece)
        ids = [rank] if rank is not None else merge(piece, self.rank_of)
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        self.memo.rest()
        return b"".join(map(self.memo.__getitem__, self.split(text)))


_WORKER: dict[str, Encoder] = {}       # one encoder per vocabulary in a Python worker


def encode(docs: DataFrame, ranks: Mapping[bytes, int], pattern: str,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (binary: little-endian uint32) of every whole text.

    NULL and empty texts give no ids. Repeated rows and NULL ids are kept as
    they are. Every single byte must be in ``ranks``.
    """
    sc = docs.sparkSession.sparkContext
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
    table = sc.broadcast(PerfectHash(ranks))
    key = uuid.uuid4().hex

    def make():
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Encoder(table.value, pattern)
        encoder = _WORKER[key]

        def run(cols):
            ids = [encoder.encode(t) for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "n_tokens": [len(b) // 4 for b in ids], "ids": ids}
        return run
    return map_batches(
        id_text(docs, id_col, text_col), make,
        pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]),
        "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks: Mapping[bytes, int], ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the bytes its ids stand for. NULL ids: no bytes.

    An id that is not in the vocabulary raises an error.
    """
    sc = encoded.sparkSession.sparkContext
    table = sc.broadcast({rank: token for token, rank in ranks.items()})
    names = [c for c in encoded.columns if c != "decoded"]

    def run(batches):
        get = table.value.__getitem__
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            out = [b"".join(map(get, np.frombuffer(b or b"", dtype="<u4").tolist())) for b in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*names, "decoded"])
    kept = encoded.select(*[encoded[c] for c in names])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{ddl}, decoded binary")


def digests(docs: DataFrame, ranks: Mapping[bytes, int], pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and SHA-256 of the ids and of the decoded bytes."""
    both = decode(encode(docs, ranks, pattern), ranks)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
