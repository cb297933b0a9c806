"""Column-level helpers (SQL-dialect semantics expressed with built-ins)."""

from agora.functions.compat import (
    count_when,
    day_of_week_sun0,
    days_between,
    float_ratio,
    hour_of,
    round_half_away,
    sum_flag,
    to_int,
    trunc_ts,
    weighted_avg,
)

__all__ = [
    "count_when", "day_of_week_sun0", "days_between", "float_ratio", "hour_of",
    "round_half_away", "sum_flag", "to_int", "trunc_ts", "weighted_avg",
]
