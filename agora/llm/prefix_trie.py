"""Prefix trie of conversations by union-find over sorted neighbours.

A node of depth d is a distinct sequence of d turns that a conversation starts
with. Conversations are rows of turn digests; sorted, all that share a prefix
lie next to each other, and the longest common prefix (LCP) of neighbours is
all the trie needs. The edges between neighbours are taken in descending LCP:
two components merge at depth l into the node of depth l that both hang under,
so every merge creates a branching node (or adds a child to one just created).
A component's members, leaves and shared text are sums over its rows and edges:

* subtree text saved: each edge inside saves the text of its common prefix;
* leaves: a row counts if its right neighbour neither equals nor extends it;
* children of a branching node: its edges of exactly its depth, and one, less
  the conversations that end there.

Nodes without a branch lie on the chain between a component and the one it
merges into and have the same members, so each row expands to the nodes it is
the first member of.

How it runs: rows (16 bytes of digest and 8 of length a turn, no text) are
range-partitioned on (digests, id), so a group of equal conversations of any
size is spread, and checkpointed. Each partition contracts its forest: of its
edges, only those that reach its first or last row below the neighbours' LCP
can be part of a node across the boundary; the stretches between them collapse
to one vertex. These contracted forests (at most one vertex a depth and side)
are merged over the boundaries in one sweep to the left and one to the right,
which gives every partition the forest beside it; the partition then runs the
union-find over both and emits the nodes whose first member it holds.

The ids of the conversations that end in a node are hashed in the order of the
rows; where they cross a boundary, their pieces are hashed in a second pass, in
order, holding one piece at a time.

One conversation is one row, so its turns (24 bytes each) must fit one. NULL
role and text count as empty, a NULL turn comes first, turns of equal number are
ordered by their digest, and repeated turns are turns of their own. Rows with a
NULL conv_id belong to no conversation. No conversations give no nodes. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.common import durable

WIDTH = 16                              # bytes of a turn's digest
ROWS = 50_000                           # conversations in a range
NONE = 1 << 62                          # the depth of a collapsed run
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
PIECE = 10_000                          # ids in a piece of a crossing group
SHARED = 5                              # turns that a conversation takes over, at most

_NODES = pa.schema([(c, pa.int64()) for c in (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string())])
_NODES_DDL = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
              "n_leaves long, saved_tokens long, ends_sha256 string")


# ---------------------------------------------------------------- conversations

def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, digests, sizes): each conversation's turns in order, as digests and text lengths."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the length of the role separates it from the text
    turn = F.concat_ws(":", F.char_length(role).cast("string"), role, text)
    digest = F.substring(F.sha2(turn, 256), 1, 2 * WIDTH)
    narrow = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"),
                 F.char_length(text).cast("long").alias("size")).alias("t"))
    ordered = narrow.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.col("t.digest").alias("digests"), F.col("t.size").alias("sizes"))


def rebuilt(convs: DataFrame, base: Column, taken: Column) -> DataFrame:
    """Each conversation with its first ``taken`` turns replaced by those of conversation ``base``.

    ``taken`` is at most ``SHARED``; all turns of a shorter base are taken, none of an absent one.
    """
    heads = convs.select(F.col("conv_id").alias("_base"),
                         F.slice("digests", 1, SHARED).alias("_digests"),
                         F.slice("sizes", 1, SHARED).alias("_sizes"))
    joined = (convs.withColumn("_base", base).withColumn("_taken", taken.cast("int"))
              .join(heads, "_base", "left"))

    def swap(head: str, own: str) -> Column:
        given = F.coalesce(F.col(head), F.array().cast(convs.schema[own].dataType))
        return F.concat(F.slice(given, F.lit(1), F.col("_taken")),
                        F.slice(F.col(own), F.col("_taken") + 1, F.greatest(F.size(own), F.lit(1))))
    return joined.select("conv_id", swap("_digests", "digests").alias("digests"),
                         swap("_sizes", "sizes").alias("sizes"))


# ---------------------------------------------------------------- contracted forests

@dataclass
class Run:
    """Neighbouring rows taken together."""
    n: int                              # rows
    least: int                          # smallest id
    leaves: int
    saved: int                          # text of the common prefixes of its edges
    first_size: int                     # turns of its first row
    copies: int                         # rows equal to its first

    def join(self, right: Run, lcp: int, text: int, edges: int = 1) -> Run:
        same = lcp == self.first_size == right.first_size
        return Run(self.n + right.n, min(self.least, right.least), self.leaves + right.leaves,
                   self.saved + right.saved + edges * text, self.first_size,
                   self.copies + (right.copies if same else 0))


@dataclass
class Edge:
    lcp: int
    text: int                           # length of the common prefix's text
    count: int = 1                      # edges of this LCP that it stands for


def contract(runs: list[Run], edges: list[Edge]) -> tuple[list[Run], list[Edge]]:
    """What a right neighbour can still see: edges that no edge to their right undercuts.

    Edge i lies between runs i and i + 1. Of equal edges one is kept, which counts them all.
    """
    kept, between = [runs[0]], []       # from left to right, LCP rising
    for run, low in zip(runs[1:], edges):
        while between and between[-1].lcp > low.lcp:         # runs behind higher edges collapse
            e, right = between.pop(), kept.pop()
            kept[-1] = kept[-1].join(right, e.lcp, e.text, e.count)
        if between and between[-1].lcp == low.lcp:
            # only what lies right of the last of equal edges is in deeper nodes
            between[-1] = Edge(low.lcp, low.text, between[-1].count + low.count)
            kept[-2] = _beside(kept[-2], kept[-1], low.lcp)
            kept[-1] = run
        else:
            between.append(low)
            kept.append(run)
    return kept, between


def _beside(a: Run, b: Run, lcp: int) -> Run:
    """``a`` and ``b`` as one, without the text of the edge between them (the kept edge counts it)."""
    return a.join(b, lcp, 0, 0)


def mirrored(runs: list[Run], edges: list[Edge]) -> tuple[list[Run], list[Edge]]:
    """What a left neighbour can still see: edges that no edge to their left undercuts."""
    kept, between = [runs[0]], []       # from left to right, LCP falling
    for run, edge in zip(runs[1:], edges):
        if not between or edge.lcp < between[-1].lcp:
            kept.append(run)
            between.append(edge)
        elif edge.lcp == between[-1].lcp:
            e = between[-1]
            between[-1] = Edge(e.lcp, e.text, e.count + edge.count)
            kept[-1] = _beside(kept[-1], run, edge.lcp)
        else:
            kept[-1] = kept[-1].join(run, edge.lcp, edge.text, edge.count)
    return kept, between


# ---------------------------------------------------------------- union-find

@dataclass
class Node:
    """A component under one branching node (or one row): nodes of its members up to ``depth``."""
    depth: int
    first: int                          # index of its first run
    run: Run
    edges: int = 0                      # edges of LCP ``depth``
    parent: Node | None = None
    alias: Node | None = field(default=None, repr=False)

    def resolve(self) -> Node:
        node = self
        while node.alias is not None:
            node = node.alias
        return node

    @property
    def above(self) -> int:
        """Depth of the node it hangs under (-1: none)."""
        return self.parent.resolve().depth if self.parent else -1

    def children(self) -> int:
        ends = self.run.copies if self.run.first_size == self.depth else 0
        return self.edges + 1 - ends


def forest(runs: list[Run], edges: list[Edge], depths: list[int]) -> list[Node]:
    """All components; ``depths[i]`` is the depth of run i taken alone."""
    nodes = [Node(depth, i, run) for i, (run, depth) in enumerate(zip(runs, depths))]
    top = list(nodes)                   # node of a component, by its union-find root
    above = list(range(len(runs)))

    def find(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    for i in sorted(range(len(edges)), key=lambda i: -edges[i].lcp):
        e = edges[i]
        left, right = find(i), find(i + 1)
        a, b = top[left], top[right]
        run = a.run.join(b.run, e.lcp, e.text, e.count)
        if a.depth == e.lcp:
            node = a
            node.run = run
            if b.depth == e.lcp:        # two parts of one node
                node.edges += b.edges
                b.alias = node
            else:
                b.parent = node
        elif b.depth == e.lcp:
            node = b
            node.run, node.first = run, a.first
            a.parent = node
        else:
            node = Node(e.lcp, a.first, run)
            nodes.append(node)
            a.parent = b.parent = node
        node.edges += e.count
        above[right] = left
        top[left] = node
    return [node for node in nodes if node.alias is None]


# ---------------------------------------------------------------- partitions

class _Part:
    """The rows of one partition, in order: ids, numbers of turns, and the edges between them."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.ids, self.turns, self.edges, self.sizes = [], [], [], []
        self.first = self.last = b""
        for batch in batches:
            for conv, key, sizes in zip(*(batch.column(i).to_pylist() for i in range(3))):
                self.sizes.append(np.cumsum(np.array(sizes, dtype=np.int64)))
                if self.ids:
                    self.edges.append(edge(self.last, key, self.sizes[-1]))
                else:
                    self.first = key
                self.ids.append(conv)
                self.turns.append(len(key) // WIDTH)
                self.last = key

    def runs(self, after: int) -> list[Run]:
        """One run a row; ``after`` is the LCP with the next partition's first row (-1: none)."""
        lcps = [e.lcp for e in self.edges] + [after]
        return [Run(1, conv, int(lcp < turns), 0, turns, 1)
                for conv, turns, lcp in zip(self.ids, self.turns, lcps)]


def edge(left: bytes, right: bytes, text: np.ndarray) -> Edge:
    """The edge between neighbours; ``text`` is the running text length of the right one."""
    n = min(len(left), len(right))
    a, b = (np.frombuffer(x[:n], dtype=np.uint8) for x in (left, right))
    differs = np.flatnonzero(a != b)
    lcp = (int(differs[0]) if len(differs) else n) // WIDTH
    return Edge(lcp, int(text[lcp - 1]) if lcp else 0)


def _pack(runs: list[Run], edges: list[Edge]) -> tuple[list, list]:
    return ([[r.n, r.least, r.leaves, r.saved, r.first_size, r.copies] for r in runs],
            [[e.lcp, e.text, e.count] for e in edges])


def _unpack(runs, edges) -> tuple[list[Run], list[Edge]]:
    return [Run(*r) for r in runs], [Edge(*e) for e in edges]


_LONGS = "array<array<long>>"
_ENDS_DDL = "part int, first binary, last binary, sizes array<long>"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and last row of a partition (digests, and text lengths of the first)."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            first = batch.slice(0, 1).to_pylist()[0] if first is None else first
            last = batch.slice(batch.num_rows - 1, 1).to_pylist()[0]
    if first is not None:
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
            "first": pa.array([first["key"]], pa.binary()), "last": pa.array([last["key"]], pa.binary()),
            "sizes": pa.array([first["sizes"]], pa.list_(pa.int64()))})


class _Bounds:
    """Boundaries of the partitions that hold rows: the edge after each, by partition."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r[0])
        self.parts = [r[0] for r in rows]
        self.after = {a[0]: edge(bytes(a[2]), bytes(b[1]), np.cumsum(np.array(b[3], dtype=np.int64)))
                      for a, b in zip(rows, rows[1:])}
        self.before = {q: self.after[p] for p, q in zip(self.parts, self.parts[1:])}
        self.first = {r[0]: bytes(r[1]) for r in rows}
        self.last = {r[0]: bytes(r[2]) for r in rows}

    def lcp_after(self, part: int) -> int:
        return self.after[part].lcp if part in self.after else -1


def _summaries(rows: DataFrame, bounds: _Bounds) -> dict[int, tuple]:
    """Both contracted forests of every partition, cut to what its neighbours can share."""
    after = {p: bounds.lcp_after(p) for p in bounds.parts}
    before = {p: bounds.before[p].lcp if p in bounds.before else -1 for p in bounds.parts}

    def cut(runs: list[Run], edges: list[Edge], limit: int) -> tuple[list[Run], list[Edge]]:
        """Edges above ``limit`` lie in nodes that do not cross: their runs collapse."""
        out_runs, out_edges = [runs[0]], []
        for run, e in zip(runs[1:], edges):
            if e.lcp > limit:
                out_runs[-1] = out_runs[-1].join(run, e.lcp, e.text, e.count)
            else:
                out_runs.append(run)
                out_edges.append(e)
        return out_runs, out_edges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        part = _Part(batches)
        if part.ids:
            runs = part.runs(after[task])
            right = _pack(*cut(*contract(runs, part.edges), after[task]))
            left = _pack(*cut(*mirrored(runs, part.edges), before[task]))
            longs = pa.list_(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([task], pa.int32()),
                **{name: pa.array([value], longs) for name, value in zip(
                    ("right_runs", "right_edges", "left_runs", "left_edges"), (*right, *left))}})
    out = rows.mapInArrow(run, f"part int, right_runs {_LONGS}, right_edges {_LONGS}, "
                               f"left_runs {_LONGS}, left_edges {_LONGS}")
    return {r[0]: (_unpack(r[1], r[2]), _unpack(r[3], r[4])) for r in out.collect()}


def _contexts(bounds: _Bounds, summaries: dict[int, tuple]) -> tuple[dict, dict]:
    """The contracted forest to the left and to the right of every partition."""
    left, held = {}, ([], [])
    for p in bounds.parts:
        if held[0]:
            left[p] = held
        runs, edges = summaries[p][0]
        joint = (held[0] + runs, held[1] + [bounds.before[p]] + edges) if held[0] else (runs, edges)
        held = contract(*joint)
    right, held = {}, ([], [])
    for p in reversed(bounds.parts):
        if held[0]:
            right[p] = held
        runs, edges = summaries[p][1]
        joint = (runs + held[0], edges + [bounds.after[p]] + held[1]) if held[0] else (runs, edges)
        held = mirrored(*joint)
    return left, right


def _crossing_hashes(rows: DataFrame, bounds: _Bounds) -> dict[int, str]:
    """SHA-256 of the ids of each group of equal rows that crosses a boundary, by its first partition."""
    starts = {}                         # (partition, key) of a part of a group: its first partition
    for p, q in zip(bounds.parts, bounds.parts[1:]):
        key = bounds.last[p]
        if key == bounds.first[q]:
            starts[q, key] = starts.setdefault((p, key), p)
    if not starts:
        return {}

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        mine = {key: g for (part, key), g in starts.items() if part == task}
        held, at = {g: [] for g in mine.values()}, 0

        def piece(g: int) -> pa.RecordBatch:
            nonlocal at
            at += 1
            text = ",".join(map(str, held[g]))
            held[g] = []
            return pa.RecordBatch.from_pydict({
                "grp": pa.array([g], pa.int32()), "part": pa.array([task], pa.int32()),
                "piece": pa.array([at], pa.int32()), "ids": pa.array([text])})
        for batch in batches if mine else ():
            for conv, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                g = mine.get(key)
                if g is not None:
                    held[g].append(conv)
                    if len(held[g]) >= PIECE:
                        yield piece(g)
        for g in held:
            if held[g]:
                yield piece(g)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha = None, None
        for batch in batches:
            for g, ids in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if g != current:
                    if sha:
                        yield out(current, sha)
                    current, sha = g, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
        if sha:
            yield out(current, sha)

    def out(g, sha) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"grp": pa.array([g], pa.int32()),
                                           "sha": pa.array([sha.hexdigest()])})
    cut = rows.mapInArrow(pieces, "grp int, part int, piece int, ids string")
    hashed = (cut.repartition("grp").sortWithinPartitions("grp", "part", "piece")
              .mapInArrow(digest, "grp int, sha string"))
    return dict(map(tuple, hashed.collect()))


def _node_rows(part: _Part, after: int, left: tuple, right: tuple, sides: tuple,
               crossing: str | None) -> Iterator[tuple]:
    """The nodes whose first member is a row of the partition."""
    local = part.runs(after)
    runs = left[0] + local + right[0]
    edges = (left[1] + ([sides[0]] if left[0] else []) + part.edges
             + ([sides[1]] if right[0] else []) + right[1])
    start = len(left[0])
    # a collapsed run is never taken for a node: no edge reaches its depth
    depths = ([NONE] * start) + part.turns + ([NONE] * len(right[0]))
    for node in forest(runs, edges, depths):
        row, run = node.first - start, node.run
        if not 0 <= row < len(local) or node.depth == NONE:
            continue
        above, text = node.above, part.sizes[row]
        for depth in range(above + 1, node.depth + 1):
            shared = int(text[depth - 2]) if depth > 1 else 0
            parent = None if depth == 0 else (
                node.parent.resolve().run.least if depth == above + 1 else run.least)
            branch = depth == node.depth
            ends = EMPTY_SHA
            if branch and run.first_size == depth:
                ids = part.ids[row:row + run.copies]
                ends = (crossing if len(ids) < run.copies
                        else hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            yield (run.least, depth, parent, run.n, node.children() if branch else 1, run.leaves,
                   run.saved - (run.n - 1) * shared, ends)


def nodes(convs: DataFrame, num_partitions: int) -> DataFrame:
    """One row per node of the trie of ``convs`` (conv_id, digests, sizes), from so many ranges."""
    by = ("key", "conv_id")
    keyed = convs.select("conv_id", F.unhex(F.array_join("digests", "")).alias("key"), "sizes")
    rows = durable(keyed.repartitionByRange(num_partitions, *by).sortWithinPartitions(*by))
    # one row a partition, then at most one run a depth and side of each partition
    bounds = _Bounds(rows.mapInArrow(_ends, _ENDS_DDL).collect())
    left, right = _contexts(bounds, _summaries(rows, bounds))
    crossing = _crossing_hashes(rows, bounds)
    beside = {p: (bounds.lcp_after(p), left.get(p, ([], [])), right.get(p, ([], [])),
                  (bounds.before.get(p), bounds.after.get(p)), crossing.get(p)) for p in bounds.parts}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Part(batches)
        if not part.ids:
            return
        found = _node_rows(part, *beside[TaskContext.get().partitionId()])
        while some := list(islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*some), _NODES)], schema=_NODES)
    return rows.mapInArrow(run, _NODES_DDL)


def trie(turns: DataFrame, base: Column, taken: Column, num_partitions: int | None = None) -> DataFrame:
    """The nodes of the rebuilt conversations of ``turns`` (conv_id, turn, role, text).

    Ranges hold about ``ROWS`` conversations, unless ``num_partitions`` gives their number.
    """
    if not num_partitions:
        about = turns.agg(F.approx_count_distinct("conv_id")).first()[0]
        num_partitions = max(about // ROWS + 1, turns.sparkSession.sparkContext.defaultParallelism)
    return nodes(rebuilt(sequences(turns), base, taken), num_partitions)


SQL = r"""
WITH own AS (
  SELECT conv_id,
         list(concat(length(coalesce(role, '')), ':', coalesce(role, ''), ':', coalesce(text, ''))
              ORDER BY turn NULLS FIRST,
                       sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), ':',
                                     coalesce(text, '')))) AS turns,
         list(length(coalesce(text, ''))::BIGINT
              ORDER BY turn NULLS FIRST,
                       sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), ':',
                                     coalesce(text, '')))) AS sizes
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
-- crc32 of the decimal id, bit by bit
taken AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT,
                  list_transform(range(1, length(conv_id::VARCHAR) + 1),
                                 lambda i: ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT)),
                lambda a, x: list_reduce(list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                  lambda b, y: xor(b >> 1, 3988292384::BIGINT * (b & 1)))), 4294967295::BIGINT) % 6 AS h
  FROM own),
conv AS (
  SELECT c.conv_id,
         list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns,
         list_concat(coalesce(b.sizes, [])[1:c.h], c.sizes[c.h + 1:]) AS sizes
  FROM taken c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
-- every node a conversation passes through
member AS (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns, sizes FROM conv),
path AS (
  SELECT conv_id, depth, turns[1:depth] AS prefix, len(turns) = depth AS ends,
         CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS size FROM member),
node AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), ''))
           AS ends_sha256
  FROM path GROUP BY prefix, depth),
child AS (
  SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n FROM node WHERE depth > 0
  GROUP BY ALL),
full_node AS (
  SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child USING (prefix, depth)),
-- every node under each of the nodes on its path, itself included
under AS (
  SELECT prefix[1:top] AS prefix, top AS depth, sum((n_children = 0)::INT)::BIGINT AS n_leaves,
         sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS top FROM full_node) GROUP BY 1, 2)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, under.n_leaves,
       under.saved_tokens, n.ends_sha256
FROM full_node n JOIN under USING (prefix, depth)
LEFT JOIN full_node p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
"""
