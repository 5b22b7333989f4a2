"""Most bought size per state and day over the preceding 5 or 10 days.

Busy states look back over fewer days than quiet ones. Orders collapse to one row
per (state, day, size) first; that small relation is staged, so the sales table is
scanned once although it feeds both the state totals and the windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import Moments, finite_or_null, is_filled, normalized
from ..operators import best_per_group, lookup_join, stage, stage_lookup, trailing_day_buckets

BOUGHT_THRESHOLD = 10_000
SHORT_WINDOW = 5
LONG_WINDOW = 10

_MOMENTS = Moments("amount")


def bought_orders(sales: DataFrame) -> DataFrame:
    """Rows that count as bought: a shipped status and a quantity other than zero.

    A missing amount keeps the row; it only stays out of the variance.
    """
    return sales.filter(
        normalized(F.col("status")).contains("shipped")
        & (F.col("qty") != 0)
        & is_filled(F.col("state"))
        & is_filled(F.col("size"))
        & F.col("order_date").isNotNull()
    ).select("state", "order_date", "size", "qty", finite_or_null(F.col("amount")).alias("amount"))


def bought_by_state(sales: DataFrame) -> DataFrame:
    return bought_orders(sales).groupBy("state").agg(F.count(F.lit(1)).alias("total"))


def daily_summary(sales: DataFrame) -> DataFrame:
    """Purchases and amount sums per (state, order_date, size)."""
    keys = ["state", "order_date", "size"]
    rows = _MOMENTS.cut(bought_orders(sales), F.col("amount"), *keys)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("purchase_count"), *_MOMENTS.first())


def window_length(total: str, threshold: int, short: int, long: int):
    return F.when(F.col(total) > threshold, F.lit(short)).otherwise(F.lit(long)).cast("int")


def state_window_length(
    daily: DataFrame, threshold: int = BOUGHT_THRESHOLD, short: int = SHORT_WINDOW, long: int = LONG_WINDOW
) -> DataFrame:
    """Bought rows per state and the window length that follows, from ``daily_summary``."""
    return (
        daily.groupBy("state")
        .agg(F.sum("purchase_count").alias("total"))
        .withColumn("window_length", window_length("total", threshold, short, long))
    )


def _buckets(daily: DataFrame, lengths: DataFrame) -> DataFrame:
    """Sums per (state, window_date, size, window_length).

    Days are brought together by (state, size) before the fan-out: a partition then
    holds a calendar's worth of rows per pair, the day copies never cross the
    network, and the final aggregate needs no further exchange.
    """
    dated = lookup_join(daily, lengths.select("state", "window_length"), "state", ["order_date", "size"])
    sums = (
        trailing_day_buckets(dated.repartition("state", "size"), "order_date", "window_length")
        .groupBy("state", "window_date", "size", "window_length")
        .agg(F.sum("purchase_count").alias("purchase_count"), *_MOMENTS.again())
    )
    return _MOMENTS.with_variance(sums, "population_variance")


def staged_windows(
    sales: DataFrame | None,
    threshold: int,
    short: int,
    long: int,
    daily: DataFrame | None = None,
    lengths: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(daily, lengths, buckets); the first two are staged, so this runs the scan.

    ``daily`` is a staged ``daily_summary`` to use instead of ``sales``, ``lengths`` a
    relation like ``state_window_length`` from elsewhere; states without one have no buckets.
    """
    daily = stage(daily_summary(sales)) if daily is None else daily
    lengths = stage_lookup(state_window_length(daily, threshold, short, long) if lengths is None else lengths)
    return daily, lengths, _buckets(daily, lengths)


def is_usable(variance: str):
    """False for buckets whose variance overflowed; they cannot be ranked."""
    return F.col(variance).isNull() | finite_or_null(F.col(variance)).isNotNull()


def window_bucket_summary(
    sales: DataFrame | None,
    threshold: int = BOUGHT_THRESHOLD,
    short: int = SHORT_WINDOW,
    long: int = LONG_WINDOW,
    daily: DataFrame | None = None,
) -> DataFrame:
    """Count, amount sums and population variance per (state, window_date, size)."""
    _, _, buckets = staged_windows(sales, threshold, short, long, daily)
    return buckets.select(
        "state",
        "window_date",
        "size",
        "window_length",
        "purchase_count",
        F.col(_MOMENTS.count).alias("amount_count"),
        _MOMENTS.total().alias("sum_amount"),
        _MOMENTS.total_squared().alias("sum_amount_squared"),
        "population_variance",
    )


def winning_category(
    sales: DataFrame | None,
    threshold: int = BOUGHT_THRESHOLD,
    short: int = SHORT_WINDOW,
    long: int = LONG_WINDOW,
    daily: DataFrame | None = None,
) -> DataFrame:
    """One winning size per (state, window_date).

    Order of preference: more purchases; a known variance before an unknown one;
    smaller variance; smaller size name.
    """
    _, _, buckets = staged_windows(sales, threshold, short, long, daily)
    return winners_of(buckets).orderBy("state", "window_date")


def winners_of(buckets: DataFrame) -> DataFrame:
    winners = best_per_group(
        buckets.filter(is_usable("population_variance")).select(
            "state", "window_date", "size", "purchase_count", "population_variance", "window_length"
        ),
        ["state", "window_date"],
        [F.col("purchase_count").desc(), F.col("population_variance").asc_nulls_last(), F.col("size").asc()],
    )
    return winners.withColumnRenamed("size", "winning_size")
