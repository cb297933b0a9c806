"""Column helpers that give the SQL semantics the marts are defined with.

Each helper is a plain ``Column -> Column`` expression built from
``pyspark.sql.functions``, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_between(start: str | Column, end: str | Column) -> Column:
    """Calendar days from ``start`` to ``end``: the number of midnights crossed.

    ``datediff(end, start)`` works on dates, so 23:00 -> 01:00 next day is 1
    (the three-argument ``datediff(day, ...)`` would count full 24 h spans).
    """
    return F.datediff(col(end), col(start)).cast("bigint")


def day_of_week_sun0(ts: str | Column) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(col(ts)) - 1).cast("bigint")


def hour_of(ts: str | Column) -> Column:
    return F.hour(col(ts)).cast("bigint")


_TRUNC_UNITS = {"month": "month", "quarter": "quarter", "week": "week", "year": "year"}


def trunc_ts(unit: str, ts: str | Column) -> Column:
    """Truncate a zone-less timestamp to month / quarter / week (Monday) / year.

    Goes through ``date`` so the result is a ``timestamp_ntz`` midnight and no
    session time zone is involved.
    """
    return F.trunc(F.to_date(col(ts)), _TRUNC_UNITS[unit]).cast("timestamp_ntz")


def float_ratio(num: str | Column, den: str | Column) -> Column:
    """``num::float / den`` as a 32-bit float, for operands of any size.

    Both sides are rounded to float first, as the 32-bit division does; the
    double quotient of two floats rounds to the same float as their own. The
    product with one keeps the optimizer from merging the casts, which would
    skip that rounding.
    """
    one = F.lit(1.0).cast("float")
    single = [(col(c).cast("float") * one).cast("double") for c in (num, den)]
    return (single[0] / single[1]).cast("float")


def to_int(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Integer cast that rounds half to even when the input is fractional."""
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.rint(col(c)).cast("int")
    return col(c).cast("int")


def round_half_away(c: str | Column, digits: int) -> Column:
    """Round a double the way ``round(x, n)`` does in the marts' SQL dialect.

    The value is scaled by 10^n, rounded half away from zero, and scaled back
    in double arithmetic. Spark's own ``round`` works on the shortest decimal
    text of the double and disagrees at near-ties (525.675 -> 525.68 there,
    525.67 here).
    """
    scale = float(10 ** digits)
    return F.round(col(c).cast("double") * F.lit(scale), 0) / F.lit(scale)


def count_when(cond: Column) -> Column:
    """``count(case when cond then 1 end)``."""
    return F.count(F.when(cond, F.lit(1)))


def sum_flag(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)``; NULL counts as false."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def weighted_avg(value: str | Column, weight: str | Column) -> Column:
    """Average of ``value`` over rows pre-collapsed into groups of ``weight`` rows.

    Equal to ``avg`` over the uncollapsed rows: NULL values are left out of
    both sum and count, and the result is NULL when no value is present.
    """
    v, w = col(value), col(weight)
    total = F.sum(v.cast("double") * w)
    n = F.sum(F.when(v.isNotNull(), w))
    return total / n


def stable_avg(value: str | Column) -> Column:
    """Average of doubles that does not depend on the order of the rows.

    A sum of doubles differs in its last bits with the order of its addends,
    so with partitioning and retries. The values are summed as whole numbers of
    1e-12, exactly; the result is within 1e-12 of the average.
    """
    v = col(value)
    units = F.floor(v * F.lit(1e12) + F.lit(0.5)).cast("decimal(20,0)")
    return F.sum(units).cast("double") / F.lit(1e12) / F.count(v)
