"""Operators Spark lacks as one call: global rank/ntile, per-key pick, checks."""

from agora.operators.dedupe import first_by, pick_one
from agora.operators.ranking import global_ntile, global_rank, global_ranks, global_row_number

__all__ = ["first_by", "global_ntile", "global_rank", "global_ranks",
           "global_row_number", "pick_one"]
