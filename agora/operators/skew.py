"""Left join to a table that is unique on the key, with hot keys spread by their measured weight.

AQE splits a skewed join partition only beyond its byte thresholds and only
along map outputs. Here every key that holds at least 1/``SHARE`` of the rows
is split into as many parts as it holds such shares, so no part of a key is
more than 1/``SHARE`` of the rows, at every size. The weights are a map-side
combined count; at most ``SHARE`` keys can be that heavy, which bounds the
broadcast, and their copies on the unique side are at most twice as many rows.
Rows with a NULL key match nothing and are dealt at random over ``SHARE`` parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 1000


def hot_keys(keys: DataFrame, on: str, share: int = SHARE) -> DataFrame:
    """(key, _parts) of the keys with at least 1/``share`` of the rows; at most ``share`` rows."""
    counts = keys.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return (counts.where(F.col("_n") * share >= total)
            .select(on, F.ceil(F.col("_n") * share / total).cast("int").alias("_parts")))


def left_lookup(many: DataFrame, one: DataFrame, on: str, spread: Column,
                keys: DataFrame | None = None, share: int = SHARE) -> DataFrame:
    """``many`` left-joined to ``one`` (unique on ``on``).

    ``keys`` is any cheap table whose ``on`` column is distributed as in
    ``many`` (default: ``many`` itself); ``spread`` is a column over ``many`` that
    differs between the rows of a key.
    """
    hot = F.broadcast(hot_keys(many if keys is None else keys, on, share))
    part = (F.when(F.col(on).isNull(), F.pmod(F.xxhash64(spread), F.lit(share)))
             .when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(spread), F.col("_parts")))
             .otherwise(0).cast("int"))
    left = many.join(hot, on, "left").withColumn("_part", part).drop("_parts")
    right = (one.join(hot, on, "left")
             .withColumn("_part", F.explode(F.sequence(
                 F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts"))
    return left.join(right, [on, "_part"], "left").drop("_part")
