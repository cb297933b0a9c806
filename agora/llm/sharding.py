"""Sharding by a Feistel permutation of global row numbers.

Rows get global numbers 0..N-1 in a fixed order; a keyed Feistel network with
cycle walking permutes [0, N), and the permuted number p gives shard p mod S
and slot p div S. Both are computable from the row number alone, the counts of
two shards differ by at most one, and the same seed gives the same shuffle.

Row numbers: narrow rows (id, size, checksum; never the text) are range
partitioned and sorted on all three, and written to the shared checkpoint
folder, which fixes their partitions; the number of rows per partition (one
number each) gives the offsets. Rows that tie on all three columns are equal
in the result, so their order does not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import durable, id_text

ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift) of x under a round key."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def permute(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Images of ``numbers`` under the permutation of [0, n) chosen by ``seed``.

    The network works on 2h bits, the least even width that holds n; an image
    outside [0, n) is permuted again until it falls inside (cycle walking).
    """
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    low, width = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [(seed * 0x2545F4914F6CDD1D + r * 0xBF58476D1CE4E5B9) % 2**64 for r in range(ROUNDS)]
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> width, out[todo] & low
            for key in keys:
                left, right = right, left ^ (_mix(right, key) & low)
            out[todo] = (left << width) | right
            todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def row_numbers(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` (0-based, in the order of all columns), and their count."""
    keys = [F.col(c).asc_nulls_first() for c in rows.columns]
    fixed = durable(rows.repartitionByRange(*keys).sortWithinPartitions(*keys))
    pid = F.spark_partition_id()
    # one number per partition of the checkpoint
    counts = dict(fixed.groupBy(pid.alias("p")).count().collect())
    offsets, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    offset = F.element_at(F.lit(offsets or [0]), pid + 1)
    index = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    return fixed.select("*", (offset + index).alias("row_number")), total


def shard(docs: DataFrame, shards: int = 24, seed: int = 20,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes of the text), ``text_crc32``, ``row_number``, ``shard``, ``slot``.

    Law: rows are spread so that the shards' counts are at most one apart; slots
    run from 0 without gaps. NULL text is empty text; NULL ids sort first;
    repeated rows are rows of their own; an empty table gives no rows.
    """
    text = F.col("text").cast("binary")
    rows = id_text(docs, id_col, text_col).select(
        "doc_id", F.octet_length(text).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"))
    numbered, total = row_numbers(rows)

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), total, seed))

    return (numbered.withColumn("_p", place("row_number"))
            .select("doc_id", "size", "text_crc32", "row_number",
                    F.expr(f"CAST(_p % {int(shards)} AS INT)").alias("shard"),
                    F.expr(f"_p div {int(shards)}").alias("slot")))
