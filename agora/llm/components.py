"""Connected components by alternating large-star and small-star rounds.

Each round points every edge at the smallest neighbour of one end, so the edge
count never grows, and the number of rounds is logarithmic in practice. A
node with very many neighbours sends one partial minimum per task, and the
join that hands its minimum back to its edges is salted. Every round is
a table in the shared folder (a checkpoint would keep the estimated size of its
plan, which squares with every round). A round is two such tables, and an edge
is turned by exploding it, not by a union of the table with itself: each branch
of a union repeats all that stands below, and the driver holds every plan. Only
the number of edges and a checksum of them reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import written

SALTS = 8


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v) edges with ``m``: the least of u and all its v."""
    least = (edges.groupBy("u").agg(F.min("v").alias("w"))
             .select("u", F.least("u", "w").alias("m"),
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    return (edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
            .join(least, ["u", "salt"]).select("u", "v", "m"))


def _ways(edges: DataFrame, *ways: tuple[str, str]) -> DataFrame:
    """For every row the (u, v) edges whose ends stand in the columns of ``ways``, without loops."""
    each = F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ways])
    return edges.select(F.explode(each).alias("e")).select("e.u", "e.v").filter("u <> v")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (columns u, v); root is the component's least node.

    NULL ends, loops and repeated edges are ignored; no edges give no rows.
    """
    e = written(edges.select("u", "v").filter("u <> v")
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(e)
    while before[0]:
        both = _ways(e, ("u", "v"), ("v", "u"))
        large = written(_with_least(both).filter("v > u")
                        .select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .filter("u <> v").distinct())
        e = written(_ways(_with_least(large), ("v", "m"), ("u", "m")).distinct())
        after = _state(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
