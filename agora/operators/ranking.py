"""Global ``row_number`` and ``ntile`` without a single-partition window.

A window with ORDER BY and no PARTITION BY moves every row into one task.
Here rows are range-partitioned on the full sort key (made total by a unique
last column), sorted inside each partition, and checkpointed to the shared
checkpoint folder, which fixes partition contents and order (and survives
executor loss). One small aggregate counts rows per partition (one number per
range partition, a bound set by the partition count, not the data); with the
running sums as a literal array, a row's global position is its partition's
offset plus its index inside the partition.

Three ways use that:

* **In place.** One ordering ranges the rows it returns: the position is a
  narrow projection of them, with no join.
* **Cut points.** ``ntile(k)`` needs only the k - 1 rows that buckets start
  with. All such orderings are ranged together as narrow rows (the ordering's
  number and its columns): one sampling, one shuffle. The counts say in which
  partition and at which index each boundary row lies; those rows are fetched
  and every row of the base is put into its bucket by comparing its sort key
  with them as literals. The base is neither shuffled nor joined.
* **Joined back.** A further ``row_number`` over the same rows has one position
  a row, so its narrow columns are ranged and joined on the ordering's last
  column, which must be unique and not NULL. So is an ``ntile`` of more than
  ``MAX_CUTS`` buckets, whose cut points would not be a small list.

The number of range partitions is left to the planner (AQE sizes them), or
fixed with ``num_partitions``. Ties: the unique last column breaks them; NULLs
sort last in both directions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.session import ensure_checkpoint_dir

Order = tuple[str, str]  # (column, "asc" | "desc")
Spec = tuple[Sequence[Order], "str | None", "Mapping[str, int] | None"]

_POS, _TOTAL = "_gpos", "_gtotal"
MAX_CUTS = 256


def sort_columns(order: Sequence[Order]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if d.lower() == "desc" else F.col(c).asc_nulls_last()
            for c, d in order]


def _local_index() -> Column:
    """Index of a row inside its partition: monotonically_increasing_id is
    (partition index << 33) + that."""
    return F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)


def _ranged(df: DataFrame, keys: Sequence[Column], num_partitions: int | None) -> DataFrame:
    """The rows in range partitions on ``keys``, sorted in each, as a checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    return ranged.sortWithinPartitions(*keys).checkpoint(eager=True)


def _positioned(df: DataFrame, order: Sequence[Order],
                num_partitions: int | None) -> tuple[DataFrame, int]:
    """All columns of ``df`` with ``_gpos`` (0-based) and ``_gtotal``, and the row count."""
    ranged = _ranged(df, sort_columns(order), num_partitions)
    pid = F.spark_partition_id()
    # rows per range partition: one small row each reaches the driver
    counts = dict(ranged.groupBy(pid.alias("p")).count().collect())
    sizes = [counts.get(p, 0) for p in range(max(counts, default=-1) + 1)]
    *offsets, total = accumulate(sizes, initial=0)
    literal = F.expr(f"array({', '.join(f'{o}L' for o in offsets) or 'CAST(0 AS BIGINT)'})")
    return ranged.select("*", (F.element_at(literal, pid + 1) + _local_index()).alias(_POS),
                         F.lit(total).cast("bigint").alias(_TOTAL)), total


def positions(df: DataFrame, order: Sequence[Order],
              num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """The ordering's columns with ``_gpos`` (0-based position) and ``_gtotal``, and the row count."""
    return _positioned(df.select(*dict.fromkeys(c for c, _ in order)), order, num_partitions)


def ntile_of(position: Column, total: Column, k: int) -> Column:
    """SQL ``ntile(k)`` bucket (1-based) of a 0-based position among ``total`` rows.

    With q = total div k and m = total mod k, the first m buckets hold q+1 rows
    and the rest q rows.
    """
    q = F.floor(total / F.lit(k)).cast("long")
    m = (total % F.lit(k)).cast("long")
    big = m * (q + 1)
    return (F.when(position < big, F.floor(position / (q + 1)) + 1)
             .otherwise(m + F.floor((position - big) / F.greatest(q, F.lit(1))) + 1)
             .cast("bigint"))


def bucket_starts(total: int, k: int) -> list[int]:
    """0-based positions of the first rows of ``ntile(k)`` buckets 2..k that are not empty."""
    q, m = divmod(total, k)
    starts = (j * q + min(j, m) for j in range(1, k))
    return [s for s in starts if s < total]


def _boundary_rows(base: DataFrame, orders: Sequence[Sequence[Order]], ks: Sequence[set[int]],
                   num_partitions: int | None) -> list[dict[int, list[tuple]]]:
    """For each ordering and each k: the sort keys of the rows that its buckets start with."""
    types = {f.name: f.dataType for f in base.schema}
    names = [[f"_o{i}_{j}" for j in range(len(order))] for i, order in enumerate(orders)]
    tagged = [F.struct(F.lit(i).alias("_ord"), *[
        (F.col(c) if i == o else F.lit(None).cast(types[c])).alias(name)
        for o, order in enumerate(orders) for name, (c, _) in zip(names[o], order)])
        for i in range(len(orders))]
    narrow = base.select(F.explode(F.array(*tagged)).alias("r")).select("r.*")
    keys = [F.col("_ord"), *(key for o, order in enumerate(orders) for key in sort_columns(
        [(name, d) for name, (_, d) in zip(names[o], order)]))]
    ranged = _ranged(narrow, keys, num_partitions)
    pid = F.spark_partition_id()
    # one small row per range partition and ordering
    counts = {(r[0], r[1]): r[2] for r in ranged.groupBy(pid.alias("p"), "_ord").count().collect()}
    parts = sorted({p for p, _ in counts})
    wanted: dict[tuple[int, int], tuple[int, int]] = {}      # (partition, index) of (ordering, position)
    for o in range(len(orders)):
        total = sum(counts.get((p, o), 0) for p in parts)
        need = sorted({s for k in ks[o] for s in bucket_starts(total, k)})
        seen = 0
        for p in parts:
            ahead = sum(counts.get((p, before), 0) for before in range(o))
            n = counts.get((p, o), 0)
            wanted.update({(o, s): (p, ahead + s - seen) for s in need if seen <= s < seen + n})
            seen += n
    at = F.struct(F.col("_p"), F.col("_i"))
    places = [F.struct(F.lit(p).cast("int"), F.lit(i).cast("bigint")) for p, i in wanted.values()]
    rows = {}
    if places:
        fetched = (ranged.select("*", pid.cast("int").alias("_p"), _local_index().alias("_i"))
                   .where(at.isin(*places)))
        rows = {(r["_p"], r["_i"]): r for r in fetched.collect()}
    out = []
    for o in range(len(orders)):
        total = sum(counts.get((p, o), 0) for p in parts)
        out.append({k: [tuple(rows[wanted[o, s]][name] for name in names[o])
                        for s in bucket_starts(total, k)] for k in ks[o]})
    return out


def _not_before(df: DataFrame, order: Sequence[Order], key: tuple) -> Column:
    """Is a row's sort key equal to ``key`` or behind it? (NULLs last.)"""
    cond = F.lit(True)
    for (name, direction), value in reversed(list(zip(order, key))):
        c, v = F.col(name), F.lit(value).cast(df.schema[name].dataType)
        same = c.eqNullSafe(v)
        if value is None:
            cond = same & cond
        else:
            beyond = (c < v) if direction.lower() == "desc" else (c > v)
            cond = c.isNull() | beyond | (same & cond)
    return cond


def _bucket(df: DataFrame, order: Sequence[Order], cuts: list[tuple]) -> Column:
    """1-based bucket of a row: one more than the cut points it is not before."""
    bucket = F.lit(1).cast("bigint")
    for key in cuts:
        bucket = bucket + F.when(_not_before(df, order, key), 1).otherwise(0).cast("bigint")
    return bucket


def _rank_columns(row_number: str | None, ntiles: Mapping[str, int] | None) -> list[Column]:
    cols = []
    if row_number:
        cols.append((F.col(_POS) + 1).cast("bigint").alias(row_number))
    for name, k in (ntiles or {}).items():
        cols.append(ntile_of(F.col(_POS), F.col(_TOTAL), k).alias(name))
    return cols


def global_rank(df: DataFrame, order: Sequence[Order], row_number: str | None = None,
                ntiles: Mapping[str, int] | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """Add a global ``row_number`` column and/or ``ntile`` columns over one ordering, in place."""
    return global_ranks(df, [(order, row_number, ntiles)], num_partitions)


def global_ranks(df: DataFrame, specs: Sequence[Spec],
                 num_partitions: int | None = None) -> DataFrame:
    """Several orderings of the same rows.

    Each spec is ``(order, row_number_name, {ntile_name: k})``. The first with a
    row number (or the only one) is ranked in place, buckets of the others come
    from cut points, and only further row numbers are joined back. The rows are
    written to the checkpoint folder once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    numbered = [i for i, (_, row_number, _) in enumerate(specs) if row_number]
    in_place = numbered[0] if numbered else 0 if len(specs) == 1 else None
    if in_place is None:
        base = df.checkpoint(eager=True)
    else:
        order, row_number, ntiles = specs[in_place]
        base, _ = _positioned(df, order, num_partitions)
        base = base.select(*df.columns, *_rank_columns(row_number, ntiles))
    rest = [i for i in range(len(specs)) if i != in_place]
    by_cuts = [i for i in rest if not specs[i][1] and max((specs[i][2] or {}).values(), default=0)
               <= MAX_CUTS]
    out = base
    if by_cuts:
        found = _boundary_rows(base, [specs[i][0] for i in by_cuts],
                               [set((specs[i][2] or {}).values()) for i in by_cuts], num_partitions)
        out = out.select("*", *[_bucket(base, specs[i][0], cuts[k]).alias(name)
                                for i, cuts in zip(by_cuts, found)
                                for name, k in (specs[i][2] or {}).items()])
    for i in rest:
        if i in by_cuts:
            continue
        order, row_number, ntiles = specs[i]
        ranked, _ = positions(base, order, num_partitions)
        key = order[-1][0]
        out = out.join(ranked.select(key, *_rank_columns(row_number, ntiles)), key, "left")
    return out.select(*df.columns, *[name for _, row_number, ntiles in specs
                                     for name in ([row_number] if row_number else []) + list(ntiles or {})])


def global_row_number(df: DataFrame, order: Sequence[Order], name: str = "row_number",
                      num_partitions: int | None = None) -> DataFrame:
    return global_rank(df, order, row_number=name, num_partitions=num_partitions)


def global_ntile(df: DataFrame, order: Sequence[Order], k: int, name: str = "ntile",
                 num_partitions: int | None = None) -> DataFrame:
    return global_rank(df, order, ntiles={name: k}, num_partitions=num_partitions)
