"""Per-group selection and group sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def best_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group. Spark cuts each task to one row per group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank_in_group", rank).filter(F.col("rank_in_group") == 1).drop("rank_in_group")


def largest_group(df: DataFrame, keys: Sequence[str], warn_above: int = 1000) -> DataFrame:
    """Skew check: rows of the largest group and whether that is above ``warn_above``."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size"))
    largest = F.coalesce(F.max("group_size"), F.lit(0))
    return sizes.agg(
        F.count(F.lit(1)).alias("group_count"),
        largest.alias("largest_group_size"),
        (largest > warn_above).alias("needs_attention"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
