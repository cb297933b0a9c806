"""Keep one row per key, chosen by an ordering, as an aggregate.

``row_number() over (partition by key order by ...) = 1`` sorts every group
inside one task, so a key holding a third of the rows lands on one executor.
The same choice written as ``max_by``/``min_by`` over a struct sort key is an
ordinary aggregate: it is combined map-side, and only one candidate per key
and map task crosses the shuffle.

Orderings follow the SQL defaults of the marts: NULLs sort last for ascending
and for descending keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Order = tuple[str, str]  # (column, "asc" | "desc")

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def _key_struct(df: DataFrame, order: Sequence[Order], want_max: bool) -> Column:
    """Struct whose max (or min) is the first row of ``order``, NULLs last."""
    parts = []
    for i, (name, direction) in enumerate(order):
        c = F.col(name)
        desc = direction.lower() == "desc"
        if desc != want_max:
            # direction opposite to the aggregate: negate (numeric keys only)
            if not isinstance(df.schema[name].dataType, _NUMERIC):
                raise ValueError(f"mixed sort directions need a numeric key, got {name}")
            c = -c
        # NULLs last: the flag ranks present values ahead of NULL
        flag = c.isNotNull() if want_max else c.isNull()
        parts += [flag.alias(f"n{i}"), c.alias(f"v{i}")]
    return F.struct(*parts)


def _aggregate_direction(df: DataFrame, order: Sequence[Order]) -> bool:
    """True for max_by, False for min_by: the direction of the non-numeric keys
    (those cannot be negated), else of the first key."""
    fixed = {d.lower() == "desc" for name, d in order
             if not isinstance(df.schema[name].dataType, _NUMERIC)}
    if len(fixed) > 1:
        raise ValueError("non-numeric sort keys must share one direction")
    return fixed.pop() if fixed else order[0][1].lower() == "desc"


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Order],
             columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first by ``order``. Returns ``keys + columns``.

    ``order`` must be total within a key for a deterministic result (end it
    with a unique column).
    """
    columns = [c for c in (columns or df.columns) if c not in keys]
    want_max = _aggregate_direction(df, order)
    key = _key_struct(df, order, want_max)
    payload = F.struct(*[F.col(c) for c in columns])
    pick = F.max_by(payload, key) if want_max else F.min_by(payload, key)
    return (df.groupBy(*keys).agg(pick.alias("_pick"))
              .select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in columns]))


def first_by(value: str, order: Sequence[Order], df: DataFrame) -> Column:
    """Aggregate expression: ``value`` of the first row by ``order`` in the group."""
    want_max = _aggregate_direction(df, order)
    key = _key_struct(df, order, want_max)
    return F.max_by(F.col(value), key) if want_max else F.min_by(F.col(value), key)
