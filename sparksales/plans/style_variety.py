"""Median number of distinct SKUs over plus-size styles, per month and state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import SIZE_RANKS, is_filled, month_key, month_start, size_rank

MIN_RANK = SIZE_RANKS["XXL"]


def style_records(sales: DataFrame) -> DataFrame:
    """Rows with a date, style, SKU, state and size, ``month`` being the first of the month.

    Status and quantity play no part.
    """
    return sales.filter(
        F.col("order_date").isNotNull()
        & is_filled(F.col("style"))
        & is_filled(F.col("sku"))
        & is_filled(F.col("state"))
        & is_filled(F.col("size"))
    ).select(
        month_start(F.col("order_date")).alias("month"),
        F.upper(F.trim(F.col("state"))).alias("state"),
        "style",
        "sku",
        size_rank(F.col("size")).alias("size_rank"),
    )


def style_variety(sales: DataFrame, min_rank: int = MIN_RANK) -> DataFrame:
    """Distinct SKUs per (month, state, style) whose largest size ranks at least ``min_rank``.

    Spark spreads the distinct count over (month, state, style, sku) first, so one
    best-selling style does not end up in one task.
    """
    return (
        style_records(sales)
        .groupBy("month", "state", "style")
        .agg(F.countDistinct("sku").alias("variety"), F.max("size_rank").alias("max_size_rank"))
        .filter(F.col("max_size_rank") >= min_rank)
        .withColumn("month", month_key(F.col("month")))
    )


def median_variety(sales: DataFrame, min_rank: int = MIN_RANK) -> DataFrame:
    """Median variety per (month, state).

    ``median`` keeps one counter per distinct variety, combined before the shuffle.
    """
    return (
        style_variety(sales, min_rank)
        .groupBy("month", "state")
        .agg(F.median("variety").alias("median_variety"))
        .orderBy("month", "state")
    )
