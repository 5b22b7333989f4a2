"""Share of a city's cancelled standard orders that had several lasting promotions
and cost less than the state's average merchant order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import Moments, is_filled, normalized, promotion_list
from ..operators import lookup_join, stage, stage_lookup

MIN_ACTIVE_DAYS = 2
MIN_VALID_PROMOTIONS = 3

_MOMENTS = Moments("amount")


def _known(row_key: Sequence[str]) -> Column:
    known = F.lit(True)
    for name in row_key:
        known = known & F.col(name).isNotNull()
    return known


def promotion_active_period(sales: DataFrame, row_key: Sequence[str] = ("row_id",)) -> DataFrame:
    """First and last order date per promotion id, over dated rows."""
    # Repeated ids change neither date, so the items need no per-row deduplication.
    return (
        sales.filter(_known(row_key) & F.col("order_date").isNotNull())
        .select("order_date", F.explode(F.split("promotion_ids", ",")).alias("item"))
        .select("order_date", F.trim("item").alias("promotion_id"))
        .filter(is_filled(F.col("promotion_id")))
        .groupBy("promotion_id")
        .agg(
            F.min("order_date").alias("first_appearance_date"),
            F.max("order_date").alias("last_appearance_date"),
        )
    )


def valid_promotions(
    sales: DataFrame, min_days: int = MIN_ACTIVE_DAYS, row_key: Sequence[str] = ("row_id",)
) -> DataFrame:
    """Promotions seen over at least ``min_days`` days."""
    days = F.datediff("last_appearance_date", "first_appearance_date")
    return promotion_active_period(sales, row_key).filter(days >= min_days).select("promotion_id")


def state_reference_avg(sales: DataFrame, row_key: Sequence[str] = ("row_id",)) -> DataFrame:
    """Average amount of merchant-fulfilled, shipped rows per state."""
    merchant = sales.filter(
        _known(row_key)
        & (normalized(F.col("fulfilment")) == "merchant")
        & (normalized(F.col("courier_status")) == "shipped")
        & is_filled(F.col("state"))
    )
    sums = _MOMENTS.cut(merchant, F.col("amount"), "state").groupBy("state").agg(*_MOMENTS.first(squares=False))
    return sums.select("state", _MOMENTS.mean().alias("reference_avg_amount"))


def _candidates(sales: DataFrame, row_key: Sequence[str]) -> DataFrame:
    return sales.filter(
        _known(row_key)
        & (normalized(F.col("status")) == "cancelled")
        & (normalized(F.col("service_level")) == "standard")
        & is_filled(F.col("city"))
    )


def valid_promotion_counts(
    sales: DataFrame,
    min_days: int = MIN_ACTIVE_DAYS,
    row_key: Sequence[str] = ("row_id",),
) -> DataFrame:
    """Number of distinct valid promotions of every order; one row for each row key.

    Ids leave the list before anything moves, so only keys and ids are shuffled. A row
    without ids keeps one filler that no id can equal and that differs between rows,
    which keeps those rows from meeting in one task. Rows of one key count together.
    """
    valid = stage_lookup(valid_promotions(sales, min_days, row_key))
    filler = F.array(F.concat(F.lit("\u0000"), F.xxhash64(*row_key).cast("string")))
    listed = sales.filter(_known(row_key)).select(*row_key, promotion_list(F.col("promotion_ids")).alias("ids"))
    ids = F.when(F.size("ids") > 0, F.col("ids")).otherwise(filler)
    exploded = listed.select(*row_key, F.explode(ids).alias("promotion_id"))
    flagged = lookup_join(exploded, valid.withColumn("is_valid", F.lit(True)), "promotion_id", row_key, "left")
    counted = F.count_distinct(F.when(F.col("is_valid"), F.col("promotion_id")))
    return flagged.groupBy(*row_key).agg(counted.alias("valid_promotion_count"))


def _valid_by_list(lists: DataFrame, valid: DataFrame) -> DataFrame:
    """(list_key, valid_promotion_count) of the different lists that have valid promotions.

    ``lists`` is read where it lies: what crosses the network is a short key and one id.
    """
    ids = F.explode(promotion_list(F.col("promotion_ids"))).alias("promotion_id")
    pairs = lists.filter(F.col("promotion_ids").isNotNull()).select("list_key", ids).distinct()
    found = lookup_join(pairs, valid.withColumn("is_valid", F.lit(True)), "promotion_id", ["list_key"], "inner")
    return found.groupBy("list_key").agg(F.count(F.lit(1)).alias("valid_promotion_count"))


def city_qualifying_pct(
    sales: DataFrame,
    min_days: int = MIN_ACTIVE_DAYS,
    min_promotions: int = MIN_VALID_PROMOTIONS,
    row_key: Sequence[str] = ("row_id",),
) -> DataFrame:
    """Per city: cancelled standard rows, how many qualify, and the percentage.

    A row can only qualify if it is below its state's average and its list has
    enough items, so every other row loses its list and is reduced to a count per
    city. The remaining rows collapse to one per (city, list), which is staged; each
    different list is taken apart once, whatever the number of cities that have it.
    """
    valid = stage_lookup(valid_promotions(sales, min_days, row_key))
    averages = stage_lookup(state_reference_avg(sales, row_key))

    text = F.coalesce(F.col("promotion_ids"), F.lit(""))
    rows = _candidates(sales, row_key).select("city", "state", "amount", text.alias("promotion_ids"))
    may_qualify = (F.col("amount") < F.col("reference_avg_amount")) & (
        F.size(F.split("promotion_ids", ",")) >= min_promotions
    )
    lists = stage(
        lookup_join(rows, averages, "state", ["city", "amount"], "left")
        .groupBy("city", F.when(may_qualify, F.col("promotion_ids")).alias("promotion_ids"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("list_key", F.md5("promotion_ids"))
    )
    counts = stage_lookup(_valid_by_list(lists, valid))
    keyed = lists.select("city", "row_count", F.when(F.col("promotion_ids").isNotNull(), F.col("list_key")).alias("list_key"))
    counted = lookup_join(keyed, counts, "list_key", ["city"], "left")
    qualifies = F.col("list_key").isNotNull() & (F.coalesce("valid_promotion_count", F.lit(0)) >= min_promotions)
    n = F.col("cancelled_standard_order_count")
    return (
        counted.groupBy("city")
        .agg(
            F.sum("row_count").alias("cancelled_standard_order_count"),
            F.sum(F.when(qualifies, F.col("row_count")).otherwise(F.lit(0))).alias("qualifying_order_count"),
        )
        .withColumn(
            "qualifying_order_percentage",
            F.col("qualifying_order_count").cast("double") * F.lit(100.0) / n.cast("double"),
        )
        .orderBy("city")
    )
