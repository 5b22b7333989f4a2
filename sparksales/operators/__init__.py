"""Reusable relational building blocks."""

from .calendar import trailing_day_buckets
from .groups import best_per_group, largest_group, row_count
from .joins import lookup_join
from .percentiles import approx_percentiles, count_histogram, with_percentiles
from .selection import exact_percentiles
from .staging import release_staged, stage, stage_lookup, staged_bytes, staging_scope

__all__ = [
    "approx_percentiles",
    "best_per_group",
    "count_histogram",
    "exact_percentiles",
    "largest_group",
    "lookup_join",
    "release_staged",
    "row_count",
    "stage",
    "stage_lookup",
    "staged_bytes",
    "staging_scope",
    "trailing_day_buckets",
    "with_percentiles",
]
