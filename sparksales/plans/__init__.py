"""The four analyses, built from the operators."""

from .city_percentage import (
    city_qualifying_pct,
    promotion_active_period,
    state_reference_avg,
    valid_promotion_counts,
    valid_promotions,
)
from .counters import ObservedWinners, quality_counters
from .style_variety import median_variety, style_records, style_variety
from .threshold_deviation import (
    approx_thresholds,
    compare_threshold_methods,
    deviation_above_thresholds,
    promotion_orders,
    threshold_stddev,
    thresholds,
)
from .winning_size import (
    bought_by_state,
    bought_orders,
    daily_summary,
    state_window_length,
    window_bucket_summary,
    winning_category,
)

__all__ = [
    "ObservedWinners",
    "approx_thresholds",
    "bought_by_state",
    "bought_orders",
    "city_qualifying_pct",
    "compare_threshold_methods",
    "daily_summary",
    "deviation_above_thresholds",
    "median_variety",
    "promotion_active_period",
    "promotion_orders",
    "quality_counters",
    "state_reference_avg",
    "state_window_length",
    "style_records",
    "style_variety",
    "threshold_stddev",
    "thresholds",
    "valid_promotion_counts",
    "valid_promotions",
    "window_bucket_summary",
    "winning_category",
]
