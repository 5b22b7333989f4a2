"""Spread of amounts among orders with unusually many promotions, per (month, SKU).

"Unusually many" is a percentile of the group's own promotion counts, found in an
approximate and an exact way. Orders are reduced to one row per (month, sku,
promotion_count) carrying counts and amount sums; thresholds, filtering and the
deviation all work on that, so the sales table is scanned and shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import Moments, is_filled, month_key, month_start, promotion_count
from ..operators import approx_percentiles, count_histogram, stage, with_percentiles
from ..operators.percentiles import (
    DEFAULT_ACCURACY,
    DEFAULT_LEVELS,
    METHODS,
    sketch_quantiles,
    sketch_size,
    task_salt,
)

GROUP = ["month", "sku"]
THRESHOLD_KEYS = [*GROUP, "method", "percentile_level", "percentile"]

_MOMENTS = Moments("amount")


def promotion_orders(sales: DataFrame, row_key: Sequence[str] = ("row_id",)) -> DataFrame:
    """Keyed, dated rows with a SKU: row key, first of the month, sku, amount, promotion_count."""
    known = F.col("order_date").isNotNull() & is_filled(F.col("sku"))
    for name in row_key:
        known = known & F.col(name).isNotNull()
    return sales.filter(known).select(
        *row_key,
        month_start(F.col("order_date")).alias("month"),
        "sku",
        "amount",
        promotion_count(F.col("promotion_ids")).alias("promotion_count"),
    )


def _histogram(orders: DataFrame, *extra: Column) -> DataFrame:
    histogram = count_histogram(orders, GROUP, "promotion_count", extra)
    return histogram.withColumn("month", month_key(F.col("month")))


def _amount_histogram(orders: DataFrame) -> DataFrame:
    rows = _MOMENTS.cut(orders, F.col("amount"), *GROUP, "promotion_count")
    return _histogram(rows, *_MOMENTS.first())


def thresholds(
    orders: DataFrame, levels: Mapping[str, float] = DEFAULT_LEVELS, methods: Sequence[str] = METHODS
) -> DataFrame:
    """Promotion-count threshold per (month, sku, method, level), from ``promotion_orders``."""
    return (
        with_percentiles(_histogram(orders), GROUP, "promotion_count", levels, methods)
        .filter("last_in_group")
        .select(*GROUP, F.explode("thresholds").alias("level"))
        .select(*GROUP, "level.*")
        .withColumnRenamed("threshold", "promotion_threshold")
    )


def approx_thresholds(
    orders: DataFrame, levels: Mapping[str, float] = DEFAULT_LEVELS, accuracy: int = DEFAULT_ACCURACY
) -> DataFrame:
    """The approximate thresholds from quantile sketches over rows."""
    found = approx_percentiles(orders, GROUP, "promotion_count", levels, accuracy)
    return found.withColumn("month", month_key(F.col("month"))).withColumnRenamed("threshold", "promotion_threshold")


def _summarise(qualifying: DataFrame) -> DataFrame:
    """Rows and deviation per threshold; 0.0 for fewer than two rows or no amount."""
    sums = qualifying.groupBy(*THRESHOLD_KEYS, "promotion_threshold").agg(
        F.sum("row_count").alias("qualifying_order_count"), *_MOMENTS.again()
    )
    deviation = F.when(F.col("qualifying_order_count") < 2, F.lit(0.0)).otherwise(
        F.coalesce(F.sqrt("amount_variance"), F.lit(0.0))
    )
    return _MOMENTS.with_variance(sums, "amount_variance").select(
        *THRESHOLD_KEYS, "promotion_threshold", "qualifying_order_count", deviation.alias("amount_stddev_pop")
    )


def deviation_above_thresholds(orders: DataFrame, given: DataFrame) -> DataFrame:
    """Apply a thresholds relation from elsewhere: rows at or above it, and their deviation."""
    joined = _amount_histogram(orders).join(given, GROUP)
    return _summarise(joined.filter(F.col("promotion_count").cast("double") >= F.col("promotion_threshold")))


def _sketched_histogram(orders: DataFrame, accuracy: int) -> DataFrame:
    """The amount histogram with a sketch of the promotion counts on each row; staged.

    The sketches come from the same scan as the sums. A salt of the task keeps the sketches of a
    hot SKU's tasks apart until few are left.
    """
    size, keys = sketch_size(accuracy), [*GROUP, "promotion_count"]
    rows = _MOMENTS.cut(orders, F.col("amount"), *keys).withColumn("task_salt", task_salt())
    parts = rows.groupBy(*keys, "task_salt").agg(
        F.count(F.lit(1)).alias("row_count"),
        *_MOMENTS.first(),
        F.kll_sketch_agg_bigint("promotion_count", F.lit(size)).alias("sketch"),
    )
    merged = parts.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"),
        *_MOMENTS.again(),
        F.kll_merge_agg_bigint("sketch", F.lit(size)).alias("sketch"),
    )
    return stage(merged.withColumn("month", month_key(F.col("month"))))


def _qualifying(histogram: DataFrame, levels: Mapping[str, float], methods: Sequence[str]) -> DataFrame:
    return (
        with_percentiles(histogram, GROUP, "promotion_count", levels, methods)
        .withColumn("level", F.explode("thresholds"))
        .filter(F.col("promotion_count").cast("double") >= F.col("level.threshold"))
        .select("*", "level.*")
        .drop("level", "thresholds", "last_in_group")
        .withColumnRenamed("threshold", "promotion_threshold")
    )


def threshold_stddev(
    sales: DataFrame,
    levels: Mapping[str, float] = DEFAULT_LEVELS,
    methods: Sequence[str] = METHODS,
    row_key: Sequence[str] = ("row_id",),
    accuracy: int | None = None,
) -> DataFrame:
    """Both methods and all levels in one scan of the sales: threshold, qualifying rows, deviation.

    By default approximate thresholds are read off the histogram, too. With ``accuracy`` they come
    from quantile sketches with a rank error of about 1 / ``accuracy``; this stages the
    histogram, so it runs the scan.
    """
    unknown = set(methods) - set(METHODS)
    if unknown or not methods:
        raise ValueError(f"methods must be some of {METHODS}, got {list(methods)}")
    orders = promotion_orders(sales, row_key)
    if accuracy is None or "approx" not in methods:
        qualifying = _qualifying(_amount_histogram(orders), levels, methods)
    else:
        sketched = _sketched_histogram(orders, accuracy)
        histogram = sketched.drop("sketch")
        of_groups = sketched.groupBy(*GROUP).agg(
            F.kll_merge_agg_bigint("sketch", F.lit(sketch_size(accuracy))).alias("sketch")
        )
        given = sketch_quantiles(of_groups, GROUP, "sketch", levels).withColumnRenamed("threshold", "promotion_threshold")
        qualifying = histogram.join(given, GROUP).filter(
            F.col("promotion_count").cast("double") >= F.col("promotion_threshold")
        )
        if "exact" in methods:
            qualifying = qualifying.unionByName(_qualifying(histogram, levels, ("exact",)))
    return _summarise(qualifying).orderBy(*GROUP, "method", "percentile_level")


def compare_threshold_methods(results: DataFrame) -> DataFrame:
    """Approximate against exact results, per level and over all levels (``ALL``).

    Both results of a (month, sku, level) are put side by side by one aggregate
    over the combined relation. Qualifying rows are all rows at or above a
    threshold, so two methods pick the same rows exactly when the counts agree.
    """

    def of(method: str, column: str):
        return F.max(F.when(F.col("method") == method, F.col(column)))

    pairs = (
        results.groupBy(*GROUP, "percentile_level")
        .agg(
            *[
                of(method, column).alias(f"{method}_{short}")
                for method in METHODS
                for short, column in (
                    ("threshold", "promotion_threshold"),
                    ("rows", "qualifying_order_count"),
                    ("deviation", "amount_stddev_pop"),
                )
            ]
        )
        .filter(F.col("approx_rows").isNotNull() & F.col("exact_rows").isNotNull())
        .select(
            F.explode(F.array(F.col("percentile_level"), F.lit("ALL"))).alias("percentile_level"),
            F.abs(F.col("approx_threshold") - F.col("exact_threshold")).alias("threshold_difference"),
            (F.col("approx_rows") != F.col("exact_rows")).alias("rows_differ"),
            F.abs(F.col("approx_deviation") - F.col("exact_deviation")).alias("deviation_difference"),
        )
    )
    return (
        pairs.groupBy("percentile_level")
        .agg(
            F.count(F.lit(1)).alias("comparisons"),
            F.count_if(F.col("threshold_difference") > 0).alias("thresholds_different"),
            F.avg("threshold_difference").alias("mean_threshold_difference"),
            F.max("threshold_difference").alias("max_threshold_difference"),
            F.count_if("rows_differ").alias("qualifying_sets_different"),
            F.count_if(F.col("deviation_difference") > 0).alias("stddevs_different"),
            F.max("deviation_difference").alias("max_stddev_difference"),
        )
        .orderBy("percentile_level")
    )
