"""Column expressions: typed parsing, promotion lists, size ranks, exact moments."""

from .moments import Moments
from .parsing import (
    clean,
    finite_or_null,
    is_filled,
    month_key,
    month_start,
    normalized,
    parse_date,
    parse_double,
    parse_long,
    parse_row_id,
)
from .promotions import promotion_count, promotion_list
from .sizes import SIZE_RANKS, size_rank

__all__ = [
    "Moments",
    "SIZE_RANKS",
    "clean",
    "finite_or_null",
    "is_filled",
    "month_key",
    "month_start",
    "normalized",
    "parse_date",
    "parse_double",
    "parse_long",
    "parse_row_id",
    "promotion_count",
    "promotion_list",
    "size_rank",
]
