"""Records of quoted CSV files whose fields may hold line breaks, read in splits.

A line break ends a record only outside quotes, and whether a split starts
inside a quoted field depends on all quotes before it. As a doubled quote
counts twice, that is the parity of the quotes so far:

1. one pass over the quote counts of the lines (integers only) gives, per
   split, its parity and whether any line in it ends with an odd count;
2. the running xor over a file's splits, in order, gives each split's state at
   its start and the split in which a record still open there began. One small
   row per split reaches the driver;
3. a second pass cuts each split into records. The pieces of the few records
   that cross a split boundary are joined; all others never leave their task.

A quote inside an unquoted field is not CSV and would shift the parity; a file
with an odd number of quotes is an error, as is a record whose fields do not
match the header.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPLIT = "file string, start long, cr boolean, odd boolean, any_odd boolean"
_PIECE = "file string, owner long, start long, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): lines in the order of the file, with the split they begin in."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("start"), "value"))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list]]:
    """((file, start), values) of stretches of lines; a split may take several stretches."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for split, rows in groupby(zip(*columns), key=lambda r: r[:2]):
            yield split, [r[2] for r in rows]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: does its first line end with CR, parity of its quotes, does any line
    end at an odd count. A line comes as twice its quotes, and one more with a CR."""
    for split, stretches in groupby(_by_split(batches), key=lambda s: s[0]):
        cr, odd, any_odd = None, 0, False
        for _, counts in stretches:
            cr = counts[0] & 1 == 1 if cr is None else cr
            for n in counts:
                odd ^= n >> 1 & 1
                any_odd = any_odd or bool(odd)
        yield pa.RecordBatch.from_pydict({
            "file": [split[0]], "start": pa.array([split[1]], pa.int64()), "cr": [cr],
            "odd": [bool(odd)], "any_odd": [any_odd]})


def split_states(splits: list[tuple]) -> dict[tuple, int | None]:
    """(file, start) of each split -> start of the split whose record is open there (None: none).

    ``splits`` are rows (file, start, cr, odd, any_odd).
    """
    states: dict[tuple, int | None] = {}
    for file, rows in groupby(sorted(splits), key=lambda r: r[0]):
        owner = None
        for _, start, _, odd, any_odd in rows:
            states[file, start] = owner
            if owner is None:
                owner = start if odd else None
            elif any_odd:                                   # the open record ends in this split
                owner = None if odd else start
        if owner is not None:
            raise ValueError(f"odd number of quotes in {file}")
    return states


def _cut(split: tuple, lines: Iterator[str], owner: int | None, cr: bool) -> Iterator[tuple]:
    """(file, owner, start, text): records, and the pieces of records that cross a boundary.

    A whole record has no owner; a piece names the split its record began in. Lines of a
    file with CR LF (``cr``) are joined by LF, also inside quotes.
    """
    file, start = split
    is_open, held, first = owner is not None, [], True
    for line in lines:
        held.append(line.removesuffix("\r") if cr else line)
        is_open ^= line.count('"') & 1 == 1
        if not is_open:
            text = "\n".join(held)
            yield (file, owner, start, text) if first and owner is not None else (file, None, start, text)
            held, first = [], False
    if held:                                                # still open: goes on in the next split
        yield file, owner if first and owner is not None else start, start, "\n".join(held)


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row ``record`` per CSV record of the file (or folder of files), headers left out.

    The first record of every file is its header. Blank lines are no records.
    """
    lines = _lines(spark, path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    cr = F.col("value").endswith("\r").cast("int")
    scanned = (lines.select("file", "start", (2 * quotes + cr).alias("n"))
               .mapInArrow(_scan, _SPLIT).collect())
    states = split_states([tuple(r) for r in scanned])
    with_cr = {r.file for r in scanned if r.start == 0 and r.cr}     # as its header ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, stretches in groupby(_by_split(batches), key=lambda s: s[0]):
            cut = _cut(split, (line for _, rows in stretches for line in rows), states[split],
                       split[0] in with_cr)
            if split[1] == 0:
                next(cut, None)                             # the header
            while some := [r for _, r in zip(range(10_000), cut)]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*some), (
                        pa.string(), pa.int64(), pa.int64(), pa.string()))],
                    names=["file", "owner", "start", "text"])
    pieces = lines.mapInArrow(run, _PIECE)
    whole = pieces.filter("owner IS NULL").select(F.col("text").alias("record"))
    if not any(owner is not None for owner in states.values()):
        joined = whole
    else:
        crossing = (pieces.filter("owner IS NOT NULL").groupBy("file", "owner")
                    .agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("p"))
                    .select(F.array_join("p.text", "\n").alias("record")))
        joined = whole.unionByName(crossing)
    return joined.filter(F.trim("record") != "")
