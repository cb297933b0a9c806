"""Substring dedup over sliding spans of sentences.

Every run of several consecutive sentences that is long enough in words is
hashed to 128 bits: three to six sentences of 20 words together (more than
three only where fewer from one end do not reach 20), two of 40, or one of 50.
Where sentences are shorter still (menus, lists, shouting), a run takes as many
as reach 20 words from its first or its last sentence. In scripts without spaces
characters count as parts of words.
All runs of all documents are grouped by hash; the first occurrence (by document
id, text hash, position) stays, and every sentence covered by any other
occurrence is removed.

Scale: one narrow row per run (no text), made again for each of its two uses;
counting and finding the smallest id is a map-side combined hash aggregate of
numbers; only repeated hashes are joined back. One passage may be in a third of all
documents: hashes with at least 1/HOT of all repeated runs (so at most HOT
hashes, which are broadcast) are salted in that join. Texts are shuffled once, to meet their spans.
"""

from __future__ import annotations

import itertools
import re
import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import durable, id_text, map_batches

WHITE = " \t\n\x0b\x0c\r"
SENTENCE = r"[^.!?。！？\n]*[.!?。！？\n][.!?。！？\x20\x09-\x0D]*|[^.!?。！？\n]+"
# Sentences in a run, and the words it has at least.
RUNS = {1: 50, 2: 40, 3: 20, 4: 20, 5: 20, 6: 20}
# Beyond the last of RUNS its words hold for any number of sentences.
MOST, LEAST = max(RUNS.items())
# Characters of scripts without spaces, and how many of them count as a word.
UNSPACED = {"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]": 2,
            "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]": 4}
SALTS, HOT = 16, 1000

_find = re.compile(SENTENCE).findall
_unspaced = [(re.compile(chars).findall, per) for chars, per in UNSPACED.items()]


def sentences(text: str) -> list[str]:
    """Pieces that join to the text; each ends with its marks and white space."""
    return _find(text)


def length(sentence: str) -> int:
    """Words of a sentence, and what its characters of scripts without spaces count for."""
    words = len(sentence.encode("utf-8").split())
    if sentence.isascii():
        return words
    return words + sum(len(find(sentence)) // per for find, per in _unspaced)


def long_runs(total: list[int]) -> list[tuple[int, int]]:
    """(first sentence, sentences) of the runs of more than MOST sentences that reach LEAST words
    only as a whole, counted from one end; ``total`` holds the words before each sentence and all.
    At most two start or end at a sentence.
    """
    out, stop = [], 0
    for i in range(len(total) - 1):             # the fewest from sentence i on
        while stop < len(total) and total[stop] - total[i] < LEAST:
            stop += 1
        if stop == len(total):
            break
        if stop - i > MOST:
            out.append((i, stop - i))
    i = -1
    for stop in range(1, len(total)):           # the fewest up to sentence stop - 1
        while total[stop] - total[i + 1] >= LEAST:
            i += 1
        if i >= 0 and stop - i > MOST and total[stop - 1] - total[i] >= LEAST:
            out.append((i, stop - i))
    return out


def runs(text: str) -> list[tuple[int, int, int, int]]:
    """(h1, h2, first sentence, sentences) of every run that is long enough."""
    pieces = sentences(text)
    words = [length(s) for s in pieces]
    marks = [xxhash.xxh3_128_digest(s.strip(WHITE)) for s in pieces]
    out = []
    total = [0, *itertools.accumulate(words)]
    for k, least in RUNS.items():
        for i in range(len(pieces) - k + 1):
            if total[i + k] - total[i] >= least and (k < 4 or total[i + k - 1] - total[i] < least
                                                     or total[i + k] - total[i + 1] < least):
                h = xxhash.xxh3_128_digest(bytes([k]) + b"".join(marks[i:i + k]))
                out.append((*struct.unpack("<qq", h), i, k))
    for i, k in long_runs(total):
        h = xxhash.xxh3_128_digest(k.to_bytes(4, "little") + b"".join(marks[i:i + k]))
        out.append((*struct.unpack("<qq", h), i, k))
    return out


def occurrences(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, row, at, k) of every run; docs has doc_id, text and row."""
    def make():
        def run(cols):
            h1, h2, doc, row, at, ks = [], [], [], [], [], []
            for d, r, text in zip(cols["doc_id"], cols["row"], cols["text"]):
                for a, b, i, k in runs(text):
                    h1.append(a), h2.append(b), at.append(i), ks.append(k)
                    doc.append(d), row.append(r)
            return {"h1": h1, "h2": h2, "doc_id": doc, "row": row, "at": at, "k": ks}
        return run
    return map_batches(docs, make, pa.schema(
        [("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()),
         ("at", pa.int32()), ("k", pa.int32())]),
        "h1 long, h2 long, doc_id long, row long, at int, k int")


def repeated(occ: DataFrame) -> DataFrame:
    """(doc_id, row, spans): array of (at, k) of the runs that are not the first of their hash.

    All buffers are fixed-width numbers, so the aggregate over all runs is a hash
    aggregate: it gives the smallest id a hash occurs in. Which run of that id is
    the first is decided among the repeated runs only.
    """
    first = durable(occ.groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.count("doc_id").alias("ids"), F.min("doc_id").alias("least"))
        .filter("n > 1").select("h1", "h2", "n", (F.col("n") > F.col("ids")).alias("null_first"), "least"))
    total = first.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT >= max(total, HOT)
    first = first.withColumn("salt", F.explode(F.when(
        hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("n")
    # the hot hashes are at most HOT rows
    hot_rows = first.filter(F.col("salt") == 1).select("h1", "h2", F.lit(True).alias("hot"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).otherwise(0)
    in_first = F.when(F.col("null_first"), F.col("doc_id").isNull()).otherwise(
        F.col("doc_id") == F.col("least"))
    hits = durable(occ.join(F.broadcast(hot_rows), ["h1", "h2"], "left").withColumn("salt", salt).drop("hot")
            .join(first, ["h1", "h2", "salt"])
            .select("h1", "h2", "doc_id", "row", "at", "k", in_first.alias("in_first")))
    # runs of one id and hash: few but in a text that repeats itself, and never more than its runs
    place = Window.partitionBy("h1", "h2").orderBy("row", "at")
    again = (hits.filter("in_first").withColumn("i", F.dense_rank().over(place)).filter("i > 1")
             .select("doc_id", "row", "at", "k"))
    gone = hits.filter("NOT in_first").select("doc_id", "row", "at", "k").unionByName(again)
    return gone.groupBy("doc_id", "row").agg(F.collect_list(F.struct("at", "k")).alias("spans"))


def cut(text: str, spans: list[tuple[int, int]]) -> tuple[str, int, int, str]:
    """Text without the covered sentences, sentences, removed ones, and their code-point spans."""
    pieces = sentences(text)
    gone = np.zeros(len(pieces) + 1, dtype=np.int64)
    for at, k in spans:
        gone[at] += 1
        gone[at + k] -= 1
    covered = np.cumsum(gone[:-1]) > 0
    kept, marks, at = [], [], 0
    for piece, out in zip(pieces, covered):
        if out:
            marks.append(f"{at}:{at + len(piece)}")
        else:
            kept.append(piece)
        at += len(piece)
    return "".join(kept), len(pieces), len(marks), ",".join(marks)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_sentences``, ``n_removed``, ``removed`` (start:end of every removed sentence)
    and ``text`` without them, one row per row of ``docs``.

    NULL text is empty text. Rows equal in id and text are one document: they
    repeat nothing of each other. A NULL id is a value of its own and comes
    first. Documents whose copy comes earlier may lose their whole text.
    Empty tables give no rows.
    """
    rows = id_text(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    spans = repeated(occurrences(rows))
    joined = rows.alias("d").join(
        spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
        & (F.col("d.row") == F.col("s.row")), "left").select("d.doc_id", "d.text", "s.spans")

    def make():
        def run(cols):
            done = [cut(t, [(s["at"], s["k"]) for s in spans or ()])
                    for t, spans in zip(cols["text"], cols["spans"])]
            text, n, removed, marks = zip(*done) if done else ((), (), (), ())
            return {"doc_id": cols["doc_id"], "n_sentences": n, "n_removed": removed,
                    "removed": marks, "text": text}
        return run
    return map_batches(joined, make, pa.schema(
        [("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()),
         ("removed", pa.string()), ("text", pa.string())]),
        "doc_id long, n_sentences long, n_removed long, removed string, text string")


def _run_sql(k: int, least: int) -> str:
    def total(first: int, last: int) -> str:
        return f"list_sum(list_slice(words, i + {first}, i + {last}))"
    short = f" AND ({total(1, k - 1)} < {least} OR {total(2, k)} < {least})" if k > 3 else ""
    return (f"SELECT doc_id, i AS pos, {k} AS k, list_slice(marks, i + 1, i + {k}) AS h "
            f"FROM (SELECT *, unnest(range(0, len(marks) - {k - 1})) AS i FROM doc) "
            f"WHERE {total(1, k)} >= {least}{short}")


_RUN_SQL = " UNION ALL ".join(_run_sql(k, least) for k, least in RUNS.items())
_UNSPACED_SQL = (
    r"[\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{3ffff}]",
    r"[\x{0e00}-\x{0eff}\x{1000}-\x{109f}\x{1780}-\x{17ff}]")
SQL = rf"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SENTENCE}') AS pieces FROM documents),
doc AS (
  SELECT doc_id, pieces,
         list_transform(pieces, lambda s: trim(s, chr(32) || chr(9) || chr(10) || chr(11)
                                                  || chr(12) || chr(13))) AS marks,
         list_transform(pieces, lambda s: len(regexp_extract_all(s, '[^\x20\x09-\x0D]+'))
           + len(regexp_extract_all(s, '{_UNSPACED_SQL[0]}')) // 2
           + len(regexp_extract_all(s, '{_UNSPACED_SQL[1]}')) // 4) AS words
  FROM split),
-- words before each boundary of sentences
edge AS (
  SELECT doc_id, j, coalesce(sum(w) OVER (PARTITION BY doc_id ORDER BY j
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS t
  FROM (SELECT doc_id, unnest(list_append(words, 0)) AS w, unnest(range(0, len(words) + 1)) AS j FROM doc)),
first_stop AS (SELECT doc_id, t, min(j) AS stop FROM edge GROUP BY doc_id, t),
last_start AS (SELECT doc_id, t, max(j) AS start FROM edge GROUP BY doc_id, t),
-- runs of more than {MOST} sentences: as few as reach {LEAST} words from one end
long_run AS (
  SELECT e.doc_id, e.j AS pos, s.stop - e.j AS k
  FROM edge e ASOF JOIN first_stop s ON e.doc_id = s.doc_id AND e.t + {LEAST} <= s.t
  UNION
  SELECT e.doc_id, s.start, e.j - s.start
  FROM edge e ASOF JOIN last_start s ON e.doc_id = s.doc_id AND e.t - {LEAST} >= s.t),
run AS ({_RUN_SQL} UNION ALL
  SELECT doc_id, pos, k, list_slice(marks, pos + 1, pos + k) FROM long_run JOIN doc USING (doc_id)
  WHERE k > {MOST}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k, h ORDER BY doc_id, pos) AS rn FROM run),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + k)) AS i FROM ranked WHERE rn > 1),
piece AS (
  SELECT doc_id, unnest(pieces) AS s, unnest(range(0, len(pieces))) AS i FROM doc),
placed AS (
  SELECT p.doc_id, p.i, p.s, g.i IS NOT NULL AS out,
         CAST(sum(length(p.s)) OVER (PARTITION BY p.doc_id ORDER BY p.i) AS BIGINT) AS stop
  FROM piece p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i),
result AS (
  SELECT doc_id, count(*) AS n_sentences, count(*) FILTER (out) AS n_removed,
         coalesce(string_agg((stop - length(s)) || ':' || stop, ',' ORDER BY i) FILTER (out), '')
           AS removed,
         coalesce(string_agg(s, '' ORDER BY i) FILTER (NOT out), '') AS text
  FROM placed GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed, '') AS removed, coalesce(r.text, '') AS text
FROM documents d LEFT JOIN result r USING (doc_id)
"""
