"""N-gram Jaccard self-join with set-relation skipping.

Sets of word shingles link when |x & y| >= t |x | y|, i.e. when their symmetric
difference D(x, y) <= (1 - t) / (1 + t) * (|x| + |y|) =: lim(x) + lim(y).

1. Equal sets are one class with a multiplicity.
2. Inverted lists hold each class's prefix only (rare shingles first, by
   counts of repeated shingles), long enough for two linked classes to share
   SHARED of its shingles (all, of smaller sets). A class leaves out of the
   lists up to OMIT of its shingles with long lists; what two linked classes
   still share first stands at positions i, j with i + j <= lim(x) + lim(y) +
   2 (shingles left out by x and y). Lists are cut into blocks by set size and
   position, and blocks that cannot hold such a pair are skipped without
   reading their entries.
3. Answers are derived from a similar set's answers. A class y near a leader p
   is a member of its group and known by its difference dy = y ^ p alone: D(y, z)
   = |dy ^ dz|. With a(y) = far |dy| - near |y|, y and z link when a(y) + a(z) <=
   2 far |dy & dz|. So members link unseen where a(y) + a(z) <= 0 (all that lie
   within lim(y) of p do) and are only counted, from the group's numbers of
   members by a; all others must share shingles of their differences, and these
   few, not the sets, are indexed. Edits of near copies seldom coincide.
4. Between groups, D is a metric: for leaders p, q the known D(p, q), |dy|, |dz|
   bound D(y, z) from both sides; only pairs that the bounds leave open are
   compared. Groups whose members' prefixes share nothing are never paired.

So a group of n near copies costs n comparisons (with its leader) and the pairs
whose edits coincide; its n^2 links are counted, not listed. Everything is
DataFrame work but the making of the sets (mapInArrow, row by row). Broadcast: a
list of frequent shingles and a bitmap, both of bounded size; neither changes
the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import id_text, join_to_unique, slices, word_hashes, written
from agora.llm.components import components

SALTS = 8
HOT_LEAST, HOT_ENTRIES = 32, 262_144     # documents of a frequent shingle; entries of their list
BITMAP_BITS = 1 << 23
SHARED = 8                               # prefix shingles that linked sets have in common
OMIT, LONG = 3, 12                       # shingles a class may leave out, length of a long list
KEYS, AGREE = 3, 4                       # minimum hashes that find leaders, and those that must agree
NEAR = 5                                 # a member differs from its leader by at most so many lim(y)
# Odd multipliers of the shingle hash and of the minimum hashes.
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIN = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D], dtype=np.uint64)


# ---------------------------------------------------------------- sets

def _mixed(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k word hashes."""
    h = np.full(max(0, len(words) - k + 1), k, dtype=np.uint64)
    for i in range(k if len(h) else 0):
        h = (h ^ words[i:len(words) - k + 1 + i]) * _MULT
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    s = np.sort(hashes)
    first = np.ones(len(s), dtype=bool)
    np.not_equal(s[1:], s[:-1], out=first[1:])
    return s[first]


def _each_set(batch: pa.RecordBatch, n: int):
    """Sorted distinct hashes of every text's n-word shingles, hashed about 250 kB of text at a time.

    Fewer words than n are one shingle.
    """
    texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
    part, size = [], 0
    for i, text in enumerate(texts):
        part.append(text.encode("utf-8").lower())
        size += len(part[-1])
        if size > 250_000 or i == len(texts) - 1:
            words, counts = word_hashes(part)
            every = _mixed(words, n)
            at = 0
            for c in counts.tolist():
                yield (_distinct(every[at:at + c - n + 1]) if c >= n
                       else _mixed(words[at:at + c], c) if c else every[:0])
                at += c
            part, size = [], 0


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def repeated_shingles(rows: DataFrame, n: int) -> np.ndarray:
    """A list, of bounded length, of shingles that many documents hold.

    Tasks report shingles seen in two or more of their documents. The list only
    orders prefixes: any list gives the same links.
    """
    def run(batches):
        held, size = [], 0
        for batch in slices(batches):
            for s in _each_set(batch, n):
                held.append(s)
                size += len(s)
                if size > 500_000:
                    yield report(held)
                    held, size = [], 0
        yield report(held)

    def report(held):
        found, count = np.unique(np.concatenate(held) if held else np.zeros(0, np.int64),
                                 return_counts=True)
        return pa.RecordBatch.from_pydict({"token": found[count > 1], "n": count[count > 1]}, schema)
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])
    counts = written(rows.select("text").mapInArrow(run, "token long, n long")
                     .groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT_LEAST))
    total = counts.agg(F.sum("n")).first()[0] or 0
    # at most total / (total / HOT_ENTRIES) = HOT_ENTRIES shingles pass
    hot = counts.filter(F.col("n") >= max(HOT_LEAST, -(-total // HOT_ENTRIES))).select("token")
    return np.sort(hot.toArrow().column("token").to_numpy())


def signatures(rows: DataFrame, hot: np.ndarray, n: int, t: int) -> DataFrame:
    """doc_id, row, size, digest, rare (its shingles outside ``hot``), prefix (those first) and
    minimum hashes of every set."""
    shared = rows.sparkSession.sparkContext.broadcast(hot)
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("size", pa.int64()),
                        ("digest", pa.binary()), ("rare", pa.int64()),
                        ("prefix", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])

    def run(batches):
        frequent = shared.value
        for batch in slices(batches):
            size, digest, rare, prefix, low = [], [], [], [], []
            for s in _each_set(batch, n):
                size.append(len(s))
                digest.append(_digest(s))
                least = -(-t * len(s) // 100)          # shingles a linked set has in common
                first = len(s) - least + min(SHARED, least)
                u = s.view(np.uint64)
                rare.append(len(s))
                if len(frequent) and len(s):
                    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    often = frequent[at] == s
                    rare[-1] = len(s) - int(often.sum())
                    s = np.concatenate((s[~often], s[often]))
                prefix.append(s[:first])
                low.append((_MIN[:, None] * u).min(axis=1).view(np.int64) if len(s)
                           else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(size, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(rare, pa.int64()), _lists(prefix), _lists(low)], schema=schema)
    return rows.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(
        run, "doc_id long, row long, size long, digest binary, rare long, prefix array<long>, "
        "low array<long>")


def digests(rows: DataFrame, n: int) -> DataFrame:
    """doc_id, row, size and digest of every set."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("size", pa.int64()),
                        ("digest", pa.binary())])

    def run(batches):
        for batch in slices(batches):
            found = [(len(s), _digest(s)) for s in _each_set(batch, n)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([k for k, _ in found], pa.int64()),
                 pa.array([d for _, d in found], pa.binary())], schema=schema)
    return rows.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(
        run, "doc_id long, row long, size long, digest binary")


def whole_sets(rows: DataFrame, classes: DataFrame, some: DataFrame, n: int) -> DataFrame:
    """(c, tokens): the whole sets of the classes ``some`` (c), written once.

    A class's set is made of one of its texts. A bitmap of the wanted texts (fixed size)
    drops most others before their sets are made; the join drops the rest.
    """
    wanted = written(classes.select("digest", "c", "text_hash").join(some, "c", "left_semi"))
    words = (wanted.select(F.col("text_hash").bitwiseAND(F.lit(BITMAP_BITS - 1)).alias("bit"))
             .groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")).toArrow())
    bitmap = np.zeros(BITMAP_BITS >> 6, dtype=np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)
    schema = pa.schema([("digest", pa.binary()), ("tokens", pa.list_(pa.int64()))])

    def run(batches):
        table, sent = shared.value, set()
        for batch in slices(batches):
            rows, bit = batch.column(0).to_pylist(), batch.column(0).to_numpy() & (BITMAP_BITS - 1)
            digests, sets, some = [], [], []
            for i in np.flatnonzero(table[bit >> 6] >> (bit & 63) & 1).tolist():
                if rows[i] not in sent:          # copies in one task are sent once
                    sent.add(rows[i])
                    some.append(i)
            for s in _each_set(batch.take(pa.array(some, pa.int64())), n):
                digests.append(_digest(s))
                sets.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), _lists(sets)],
                                             schema=schema)
    # a task sends a text's set once, so nothing is combined before the shuffle: whole sets are
    # sorted where no Python worker runs beside
    found = (rows.select(F.xxhash64("text").alias("row"), "text").mapInArrow(run, "digest binary, tokens array<long>")
             .repartition("digest").groupBy("digest").agg(F.first("tokens").alias("tokens")))
    return written(found.join(wanted, "digest").select("c", "tokens"))


# ---------------------------------------------------------------- links

class _Limit:
    """lim(x) + lim(y) >= D as integers: far * D <= near * (|x| + |y|)."""

    def __init__(self, t: int):
        self.near, self.far = 100 - t, 100 + t


def _spread(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _rows(df: DataFrame, *rows: dict[str, str]) -> DataFrame:
    """Each of ``rows`` (name: column) for every row of ``df``, which is read once for all of them."""
    each = F.array(*[F.struct(*[F.col(c).alias(k) for k, c in row.items()]) for row in rows])
    return df.select(F.explode(each).alias("_row")).select("_row.*")


def _salt(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int")


def _difference(pairs: DataFrame, sets: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``pairs`` with D of the classes in columns a and b."""
    left = sets.select(F.col("c").alias(a), F.col("tokens").alias("_l"))
    right = sets.select(F.col("c").alias(b), F.col("tokens").alias("_r"))
    both = pairs.join(left, a).join(right, b)
    return both.withColumn(out, (F.size("_l") + F.size("_r")
                                 - 2 * F.size(F.array_intersect("_l", "_r"))).cast("long")
                           ).drop("_l", "_r")


def leaders(rows: DataFrame, classes: DataFrame, limit: _Limit, words: int
            ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every class's group: (c, size, copies, leader, far, a, node), far being D to the leader;
    the differences (c, diff) of the members; and the sets compared.

    Of the classes that share one of its first minimum hashes and agree in most
    of all of them, a class aims at the one with fewest rare shingles (the text
    the others are copies of has none of their edits; ties: the first); a class
    that aims at none is a leader. Each class is compared with one leader, the one it aims at or that
    class's own, and joins its group if D is at most NEAR lim. Members within lim of the
    leader are one node with it, as they link with each other; any other is a node of its own.
    """
    low = classes.select("c", "low")
    keyed = classes.select(F.struct("rare", "c").alias("me"),
                           F.posexplode("low").alias("r", "key")).filter(F.col("r") < KEYS)
    pivots = (keyed.groupBy("r", "key").agg(F.min("me").alias("top"), F.count("*").alias("n"))
              .filter("n > 1").drop("n"))
    aims = (keyed.withColumn("salt", _salt("me")).join(_spread(pivots), ["r", "key", "salt"])
            .filter("top < me").select(F.col("me.c").alias("c"), F.col("top.c").alias("to"),
                                       F.col("top.rare").alias("rare")).distinct())
    aims = written(_agreeing(aims, low).groupBy("c").agg(F.min(F.struct("rare", "to")).alias("top"))
                   .select("c", F.col("top.to").alias("to")))
    over = aims.select(F.col("c").alias("to"), F.col("to").alias("top"))
    tries = aims.join(over, "to", "left").select("c", F.coalesce("top", "to").alias("to"))
    # a class aimed at may itself aim elsewhere: only those that do not are leaders
    lead = tries.select("to").distinct().join(aims.select(F.col("c").alias("to")), "to", "left_anti")
    tries = written(_agreeing(tries.join(lead, "to"), low))
    sets = whole_sets(rows, classes, _rows(tries, {"c": "c"}, {"c": "to"}).distinct(), words)
    close = _near(tries, sets, classes, limit)
    state = classes.select("c", "size", "copies").join(close.drop("diff"), "c", "left").select(
        "c", "size", "copies", F.coalesce("to", "c").alias("leader"),
        F.coalesce("far", F.lit(0)).cast("long").alias("far"))
    return written(_placed(state, limit)), close.select("c", "diff"), sets


def _near(tries: DataFrame, sets: DataFrame, classes: DataFrame, limit: _Limit) -> DataFrame:
    """(c, to, far, diff) of the (c, to) pairs whose D is at most NEAR lim(c)."""
    # a leader of very many has its set salted
    weighed = tries.groupBy("to").agg(F.count("*").alias("n"))
    led = written(sets.withColumnRenamed("c", "to").withColumnRenamed("tokens", "_l").join(weighed, "to"))
    both = join_to_unique(tries.join(sets.withColumnRenamed("tokens", "_r"), "c"), led, ["to"], "n",
                          F.xxhash64("c"))
    return written(both.select("c", "to", F.array_union(F.array_except("_l", "_r"),
                                                        F.array_except("_r", "_l")).alias("diff"))
                   .withColumn("far", F.size("diff").cast("long"))
                   .join(classes.select("c", "size"), "c")
                   .filter(limit.far * F.col("far") <= NEAR * limit.near * F.col("size"))
                   .select("c", "to", "far", "diff"))


def _placed(state: DataFrame, limit: _Limit) -> DataFrame:
    """Classes (c, size, copies, leader, far) with a and node."""
    return (state.withColumn("a", limit.far * F.col("far") - limit.near * F.col("size"))
            .withColumn("node", F.when(F.col("a") <= 0, F.col("leader")).otherwise(F.col("c"))))


def adopted(classes: DataFrame, state: DataFrame, diffs: DataFrame, pairs: DataFrame,
            sets: DataFrame, limit: _Limit) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``state``, ``diffs`` and the leader ``pairs`` after groups took in what `leaders` missed.

    A leader without followers whose minimum hashes missed a group near it would be compared with
    all of that group's members. Its pair with the group's leader shows it: of the leaders
    with followers it is paired with, it is compared with the one with most, and is a
    member like others if D is at most NEAR lim. A pair of leaders becomes the pair of
    their groups.
    """
    led = written(state.filter("leader <> c").groupBy("leader").agg(F.count("*").alias("n")))
    both = _rows(pairs, {"c": "p", "to": "q"}, {"c": "q", "to": "p"})
    tries = written(both.join(led.select(F.col("leader").alias("to"), "n"), "to")
                    .join(led.select(F.col("leader").alias("c")), "c", "left_anti")
                    .groupBy("c").agg(F.max(F.struct("n", "to")).alias("top"))
                    .select("c", F.col("top.to").alias("to")))
    if tries.isEmpty():
        return state, diffs, pairs
    close = _near(tries, sets, classes, limit)
    taken = close.select("c", "to", F.col("far").alias("d"))
    state = state.join(taken, "c", "left").select(
        "c", "size", "copies", F.coalesce("to", "leader").alias("leader"),
        F.coalesce("d", "far").alias("far"))
    into = lambda k: taken.select(F.col("c").alias(k), F.col("to").alias(f"{k}_to"))
    moved = (pairs.join(into("p"), "p", "left").join(into("q"), "q", "left")
             .select(F.coalesce("p_to", "p").alias("p"), F.coalesce("q_to", "q").alias("q"))
             .filter("p <> q").select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"))
             .distinct())
    return (written(_placed(state, limit)), diffs.unionByName(close.select("c", "diff")),
            written(moved))


def _agreeing(pairs: DataFrame, low: DataFrame) -> DataFrame:
    """The (c, to) pairs of which at least AGREE minimum hashes are equal."""
    columns = pairs.columns
    both = pairs.join(low.withColumnRenamed("low", "_c"), "c").join(
        low.select(F.col("c").alias("to"), F.col("low").alias("_t")), "to")
    same = F.zip_with("_c", "_t", lambda x, y: (x == y).cast("int"))
    return both.filter(F.aggregate(same, F.lit(0), lambda n, x: n + x) >= AGREE).select(
        *columns)


def common_entries(classes: DataFrame) -> DataFrame:
    """(c, token, pos, n) of the prefix shingles that n >= 2 classes hold, written once."""
    entries = classes.select("c", F.posexplode("prefix").alias("pos", "token"))
    common = written(entries.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1"))
    both = join_to_unique(entries, common.withColumn("list", F.col("n")), ["token"], "n",
                          F.xxhash64("c"))
    return written(both.select("c", "token", "pos", F.col("list").alias("n")))


def listed(entries: DataFrame, classes: DataFrame, t: int) -> DataFrame:
    """(c, token, size, pos, prev): the inverted lists' entries.

    pos is less by twice what c leaves out; prev is c's entry before this one.
    """
    entries = entries.join(classes.select("c", "size", "rare"), "c")
    # a set can spare some if all it may link with share SHARED shingles with it
    enough = F.col("size") * t * t >= SHARED * 10_000
    spare = (F.col("n") >= LONG) & (F.col("pos") < F.col("rare")) & enough
    by_length = Window.partitionBy("c").orderBy(F.desc("spare"), F.desc("n"), "token")
    ranked = (entries.withColumn("spare", spare)
              .withColumn("out", (F.row_number().over(by_length) <= OMIT) & F.col("spare"))
              .withColumn("left_out", F.count(F.when(F.col("out"), 1))
                          .over(Window.partitionBy("c"))))
    by_place = Window.partitionBy("c").orderBy("pos")
    return ranked.filter(~F.col("out")).select(
        "c", "token", "size", (F.col("pos") - 2 * F.col("left_out")).alias("pos"),
        F.lag("token").over(by_place).alias("prev"))


def candidates(classes: DataFrame, state: DataFrame, limit: _Limit, t: int) -> DataFrame:
    """Distinct leader pairs (p < q) some of whose classes may link, from blocks of inverted lists."""
    common = common_entries(classes)
    entries = (listed(common, classes, t).join(state.select("c", "leader"), "c")
               .groupBy("token", "leader")
               .agg(F.min("pos").alias("pos"), F.min("size").alias("least"),
                    F.max("size").alias("most"),
                    F.when(F.count("*") == 1, F.min("prev")).alias("prev")))
    # blocks of a list: by size (a band is one factor of t) and by position
    band = F.floor(F.log("least") / np.log(100 / t)).cast("long")
    block = F.floor(F.log2(F.greatest("pos", F.lit(0)) + 1)).cast("int")
    lists = written(
        entries.withColumn("band", band).withColumn("block", block)
        .groupBy("token", "band", "block", _salt("leader").alias("part"))
        .agg(F.collect_list(F.struct("leader", "pos", "least", "most", "prev")).alias("entries"),
             F.min("pos").alias("pos"), F.min("least").alias("least"),
             F.max("most").alias("most")))
    a, b = lists.alias("a"), lists.alias("b")
    key = lambda s: F.struct(*[F.col(f"{s}.{c}") for c in ("band", "block", "part")])

    def close(x: str, y: str) -> Column:
        return ((100 * F.col(f"{x}.most") >= t * F.col(f"{y}.least"))
                & (100 * F.col(f"{y}.most") >= t * F.col(f"{x}.least"))
                & (limit.far * (F.col(f"{x}.pos") + F.col(f"{y}.pos"))
                   <= limit.near * (F.col(f"{x}.most") + F.col(f"{y}.most"))))
    blocks = a.join(b, (F.col("a.token") == F.col("b.token")) & (key("a") <= key("b"))
                    & close("a", "b"))
    # the pairs of a block, filtered as they are made; a pair that also shares the
    # entry before is made there
    ys = F.filter(F.col("ys"), lambda y: (
        F.when(F.col("same"), F.col("x.leader") < y["leader"]).otherwise(F.lit(True))
        & ~F.coalesce(F.col("x.prev") == y["prev"], F.lit(False))
        & (100 * F.col("x.most") >= t * y["least"]) & (100 * y["most"] >= t * F.col("x.least"))
        & (limit.far * (F.col("x.pos") + y["pos"]) <= limit.near * (F.col("x.most") + y["most"]))))
    pairs = (blocks.select(F.explode("a.entries").alias("x"), F.col("b.entries").alias("ys"),
                           (key("a") == key("b")).alias("same"))
             .select("x.leader", F.explode(ys).alias("y")))
    pairs = written(pairs.select(F.least("leader", "y.leader").alias("p"),
                                 F.greatest("leader", "y.leader").alias("q")).distinct())
    # two leaders without followers: their prefixes share enough, or they do not link
    followed = state.filter("leader <> c").select(F.col("leader").alias("c")).distinct()
    need = F.least(F.lit(SHARED), F.ceil(F.col("size") * t / 100))
    alone = (common.groupBy("c").agg(F.collect_list("token").alias("held"))
             .join(classes.select("c", need.alias("need")), "c").join(followed, "c", "left_anti"))
    side = lambda k: alone.select(F.col("c").alias(k), F.col("held").alias(f"{k}_held"),
                                  F.col("need").alias(f"{k}_need"))
    both = pairs.join(side("p"), "p", "left").join(side("q"), "q", "left")
    shared = F.size(F.array_intersect("p_held", "q_held"))
    return both.filter(F.col("p_need").isNull() | F.col("q_need").isNull()
                       | (shared >= F.least("p_need", "q_need"))).select("p", "q")


def group_links(state: DataFrame, diffs: DataFrame, limit: _Limit) -> tuple[DataFrame, DataFrame]:
    """Links inside groups: (u, v) edges of nodes, and (c, n) link counts of classes."""
    members = written(state.join(state.filter("leader <> c").select("leader").distinct(),
                                 "leader", "left_semi"))
    # sure: a(y) + a(z) <= 0. Copies by a, summed up to -a of every a that occurs
    by_a = written(members.groupBy("leader", "a").agg(F.sum("copies").alias("w")))
    points = by_a.select("leader", F.col("a").alias("v"), "w", F.lit(0).alias("ask")).unionByName(
        by_a.select("leader", (-F.col("a")).alias("v"), F.lit(0).cast("long").alias("w"),
                    F.lit(1).alias("ask")))
    upto = (Window.partitionBy("leader").orderBy("v", "ask")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = (points.withColumn("sure", F.sum("w").over(upto)).filter("ask = 1")
            .select("leader", (-F.col("v")).alias("a"), "sure"))
    # a class counts itself where 2 a <= 0
    own = members.join(sums, ["leader", "a"]).select("c", (
        F.col("sure") - F.when(F.col("a") <= 0, F.col("copies")).otherwise(0)).alias("n"))
    least = by_a.groupBy("leader").agg(F.min("a").alias("least"))
    linked = (by_a.join(least, "leader").filter("a > 0 AND a + least <= 0").select("leader", "a"))
    edges = members.join(linked, ["leader", "a"]).select(F.col("node").alias("u"), F.col("leader").alias("v"))
    # all others: at least one beyond lim, and shared shingles in the differences
    entry = diffs.join(members.select("c", "leader", "a"), "c").select(
        "leader", F.explode("diff").alias("token"), "c", "a", F.size("diff").alias("n"))
    common = written(entry.groupBy("leader", "token").agg(F.count("*").alias("w")).filter("w > 1"))
    held = join_to_unique(entry, common.withColumn("list", F.col("w")), ["leader", "token"], "w",
                          F.xxhash64("c"))
    # rare ones first; shingles in one difference only stand before them
    place = Window.partitionBy("c").orderBy("list", "token")
    left = (F.col("n") - (F.col("n") - F.count("*").over(Window.partitionBy("c")))
            - F.row_number().over(place) + 1)
    held = written(held.select("leader", "token", "c", "a", left.alias("left")))
    # of two beyond lim, what is left from the shared shingle on must be enough; each by itself first
    apart = held.filter(f"a > 0 AND 2 * {limit.far} * left >= a + 1")
    x, y = apart.alias("x"), apart.alias("y")
    enough = F.col("x.a") + F.col("y.a") <= 2 * limit.far * F.least("x.left", "y.left")
    same = (F.col("x.leader") == F.col("y.leader")) & (F.col("x.token") == F.col("y.token"))
    two = x.join(y, same & (F.col("x.c") < F.col("y.c")) & enough)
    near = held.filter("a <= 0").alias("y")
    one = held.filter("a > 0").alias("x").join(
        near, same & enough & (F.col("x.a") + F.col("y.a") > 0))
    pairs = two.select("x.c", F.col("y.c").alias("z")).unionByName(
        one.select("x.c", F.col("y.c").alias("z"))).distinct()
    side = members.select("c", "a", "copies", "node").join(diffs, "c")
    both = (pairs.join(side, "c").join(side.select(*[F.col(k).alias("z" if k == "c" else f"z_{k}")
                                                     for k in side.columns]), "z")
            .filter(F.col("a") + F.col("z_a")
                    <= 2 * limit.far * F.size(F.array_intersect("diff", "z_diff")))
            .select("c", "z", "copies", "z_copies", "node", "z_node"))
    both = written(both)
    edges = edges.unionByName(both.select(F.col("node").alias("u"), F.col("z_node").alias("v"))).distinct()
    counts = (own.unionByName(_rows(both, {"c": "c", "n": "z_copies"}, {"c": "z", "n": "copies"}))
              .groupBy("c").agg(F.sum("n").alias("n")))
    return written(edges), written(counts)


def cross_links(pairs: DataFrame, state: DataFrame, compared: DataFrame, sets: DataFrame,
                limit: _Limit) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links between groups: (u, v) edges of nodes, (leader, n) and (c, n) link counts.

    With a(y) = far D(p, y) - near |y| and b(y) = far D(p, y) + near |y|:
    y, z link if far D(p, q) + a(y) + a(z) <= 0, and do not if far D(p, q) >
    b(y) + b(z). The bounds are tried on whole groups, then on a class and a
    group, then on two classes; what is still open is compared. ``sets`` holds
    the whole sets of the leaders paired, ``compared`` those of the groups.
    """
    members = state.select("c", "size", "copies", "leader", "node", "a",
                           (limit.far * F.col("far") + limit.near * F.col("size")).alias("b"))
    groups = members.groupBy("leader").agg(F.sum("copies").alias("copies"), F.max("a").alias("a"),
                                           F.max("b").alias("b"))

    def side(df: DataFrame, key: str, prefix: str) -> DataFrame:
        return df.select(F.col("leader").alias(key), *[F.col(c).alias(f"{prefix}_{c}")
                                                       for c in df.columns if c != "leader"])
    known = _difference(pairs, sets, "p", "q", "d").withColumn("d", limit.far * F.col("d"))
    known = (known.join(side(groups, "p", "gp"), "p").join(side(groups, "q", "gq"), "q")
             .filter("d <= gp_b + gq_b"))
    known = written(known.withColumn("all", F.expr("d + gp_a + gq_a <= 0")))
    whole = known.filter("all")
    # one class y of p against all of q
    ones = written(known.filter("NOT all").join(side(members, "p", "y"), "p")
                   .filter("d <= y_b + gq_b")
                   .withColumn("every", F.expr("d + y_a + gq_a <= 0")))
    every = ones.filter("every")
    twos = (ones.filter("NOT every").join(side(members, "q", "z"), "q")
            .filter("d <= y_b + z_b").withColumn("sure", F.expr("d + y_a + z_a <= 0")))
    twos = written(twos.select("p", "q", "y_c", "y_node", "y_size", "y_copies", "z_c", "z_node",
                               "z_size", "z_copies", "sure"))
    single, still = twos.filter("sure"), twos.filter("NOT sure")
    if not still.isEmpty():
        # a class in a group was compared with its leader, one without is in ``pairs``
        sets = sets.union(compared).groupBy("c").agg(F.first("tokens").alias("tokens"))
        near = _difference(still, sets, "y_c", "z_c", "e").filter(
            limit.far * F.col("e") <= limit.near * (F.col("y_size") + F.col("z_size"))).drop("e")
        single = written(single.unionByName(near))
    # a group all of which links with something else is one component with its leader's node
    joined = (_rows(whole, {"leader": "p"}, {"leader": "q"})
              .unionByName(every.select(F.col("q").alias("leader"))).distinct())
    edges = (whole.select(F.col("p").alias("u"), F.col("q").alias("v"))
             .unionByName(every.select(F.col("y_node").alias("u"), F.col("q").alias("v")))
             .unionByName(single.select(F.col("y_node").alias("u"), F.col("z_node").alias("v")))
             .unionByName(members.filter("node <> leader").join(joined, "leader", "left_semi")
                          .select(F.col("node").alias("u"), F.col("leader").alias("v"))).distinct())
    by_leader = (_rows(whole, {"leader": "p", "n": "gq_copies"}, {"leader": "q", "n": "gp_copies"})
                 .unionByName(every.select(F.col("q").alias("leader"), F.col("y_copies").alias("n")))
                 .groupBy("leader").agg(F.sum("n").alias("n")))
    by_class = (every.select(F.col("y_c").alias("c"), F.col("gq_copies").alias("n"))
                .unionByName(_rows(single, {"c": "y_c", "n": "z_copies"}, {"c": "z_c", "n": "y_copies"})))
    return written(edges), written(by_leader), written(by_class)


def join(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (least id reachable by links) and ``n_links`` of
    every row.

    Sets link when 100 |x & y| >= ``percent`` |x | y|. NULL and empty texts, and
    texts without a word, are an empty set that links with nothing: their
    component is their own id. Repeated rows are linked rows of their own (each
    counts as a link of the other). A NULL id takes part in links and never is
    the least unless all are NULL. Empty tables give no rows.
    """
    return _join(id_text(docs, id_col, text_col), words, percent).drop("row", "root")


def _join(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """``join``'s columns, ``row`` (hash of the text) and ``root``: the component's class."""
    limit = _Limit(percent)
    signed = signatures(rows, repeated_shingles(rows, words), words, percent)
    classes = written(signed.filter("size > 0").groupBy("digest").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least_id"),
        F.first("size").alias("size"), F.first("rare").alias("rare"), F.first("prefix").alias("prefix"),
        F.first("low").alias("low"), F.min("row").alias("text_hash"))
        .withColumn("c", F.monotonically_increasing_id()))               # fixed by the table
    state, diffs, compared = leaders(rows, classes, limit, words)
    pairs = written(candidates(classes, state, limit, percent))
    sets = whole_sets(rows, classes, _rows(pairs, {"c": "p"}, {"c": "q"}).distinct(), words)
    state, diffs, pairs = adopted(classes, state, diffs, pairs, sets, limit)
    inside, own_n = group_links(state, diffs, limit)
    edges, by_leader, by_class = cross_links(pairs, state, compared, sets, limit)
    roots = components(edges.unionByName(inside))
    nodes = written(state.join(classes.select("c", "least_id"), "c")
                    .groupBy("node").agg(F.min("least_id").alias("least_id"), F.count("*").alias("n"))
                    .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    # few roots hold very many nodes, few nodes and groups very many classes
    least = written(nodes.groupBy("root").agg(F.min("least_id").alias("component_id"),
                                              F.count("*").alias("w")))
    nodes = written(join_to_unique(nodes.select("node", "root", "n"), least, ["root"], "w",
                                   F.xxhash64("node")))
    counts = (by_class.unionByName(own_n).groupBy("c").agg(F.sum("n").alias("n")))
    linked = written(join_to_unique(state.select("c", "leader", "node", "copies"), nodes, ["node"], "n",
                                    F.xxhash64("c")))
    weighed = written(by_leader.join(state.groupBy("leader").agg(F.count("*").alias("w")), "leader")
                      .withColumnRenamed("n", "links"))
    linked = (join_to_unique(linked, weighed, ["leader"], "w", F.xxhash64("c"), how="left")
              .join(counts, "c", "left")
              .select("c", "root", F.col("component_id").alias("far_id"),
                      (F.col("copies") - 1 + F.coalesce("links", F.lit(0)) + F.coalesce("n", F.lit(0)))
                      .alias("far_links")))
    answer = (classes.select("digest", "c", "copies", "least_id").join(linked, "c", "left")
              .select("digest", "copies", F.coalesce("root", "c").alias("root"), F.coalesce("far_id", "least_id").alias("component_id"),
                      F.coalesce("far_links", F.col("copies") - 1).alias("n_links")))
    # the sets' digests are made again: cheaper than keeping the prefixes for it
    whole = join_to_unique(digests(rows, words), written(answer), ["digest"], "copies",
                           F.xxhash64("doc_id", "row"), how="left")
    return whole.select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "row", "root")


def representatives(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per component: the least id (NULL last), then the least text hash.

    Rows without a word link with nothing and stay. Rows equal in id and text
    are one document: one of them stays.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
                         docs[id_col].cast("long").alias("doc_id"),
                         F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
                         .alias("row"))
    found = _join(id_text(docs, id_col, text_col), words, percent)
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    # a row without a word is a group of its own; one grouping, so the sets are made once more only
    alone = [F.when(F.col("root").isNull(), F.col(c)) for c in ("doc_id", "row")]
    kept = (found.groupBy("root", *alone).agg(F.min(place).alias("k"))
            .select("k.doc_id", "k.row"))
    one = packed.groupBy("doc_id", "row").agg(F.first("whole").alias("whole"))
    stay = one.alias("d").join(kept.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
                               & (F.col("d.row") == F.col("k.row")), "left_semi")
    return stay.select(*[F.col(f"whole.`{c}`").alias(c) for c in docs.columns])


SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
         ELSE list_transform(range(1, len(w) - 2), lambda i: list_slice(w, i, i + 3)) END) AS s
  FROM doc),
item AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM item a JOIN item b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pair WHERE 100 * common >= 85 * (nx + ny - common)),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
root AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
links AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(root.y, doc_id)) AS component_id,
       coalesce(links.n, 0) AS n_links
FROM sets LEFT JOIN root ON root.x = doc_id LEFT JOIN links ON links.x = doc_id
"""
