"""Data-quality counters of the winning-size analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..operators import lookup_join
from .winning_size import (
    BOUGHT_THRESHOLD,
    LONG_WINDOW,
    SHORT_WINDOW,
    is_usable,
    staged_windows,
    winners_of,
)


def quality_counters(
    sales: DataFrame | None,
    threshold: int = BOUGHT_THRESHOLD,
    short: int = SHORT_WINDOW,
    long: int = LONG_WINDOW,
    daily: DataFrame | None = None,
    lengths: DataFrame | None = None,
) -> DataFrame:
    """One (counter, value) row each.

    ``lengths``: window lengths from elsewhere, for instance an earlier export's; orders of
    states that it lacks are counted as ``missing_state_window`` and have no buckets.

    ``buckets_emitted`` is the number of (order, window day) pairs, which must equal
    the sum over states of orders times window length.
    """
    daily, lengths, buckets = staged_windows(sales, threshold, short, long, daily, lengths)
    of_buckets = (
        buckets.groupBy("state", "window_date")
        .agg(*[metric.alias(name) for name, metric in _of_buckets().items()], F.max(is_usable("population_variance")).alias("has_winner"))
        .agg(*[_none_as_zero(F.sum(name)).alias(name) for name in _of_buckets()], F.count_if("has_winner").alias("winners_selected"))
    )
    return _all_counters(daily, lengths, threshold, of_buckets)


def _none_as_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0)).cast("bigint")


def _of_buckets() -> dict[str, Column]:
    return {
        "buckets_emitted": _none_as_zero(F.sum("purchase_count")),
        "candidates": F.count(F.lit(1)),
        "malformed_buckets": F.count_if(~is_usable("population_variance")),
    }


def _all_counters(daily: DataFrame, lengths: DataFrame, threshold: int, of_buckets: DataFrame) -> DataFrame:
    of_orders = daily.agg(
        _none_as_zero(F.sum("purchase_count")).alias("bought_orders"),
        _none_as_zero(F.sum(F.col("purchase_count") - F.col("amount_count"))).alias("bought_orders_without_amount"),
    )
    of_states = lengths.agg(
        F.count(F.lit(1)).alias("states"),
        F.count_if(F.col("total") > threshold).alias("states_with_short_window"),
        _none_as_zero(F.sum(F.col("total") * F.col("window_length"))).alias("buckets_expected"),
    )
    unmatched = lookup_join(daily, lengths, "state", ["order_date", "size"], "left_anti").agg(
        _none_as_zero(F.sum("purchase_count")).alias("missing_state_window")
    )

    def as_rows(wide: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(name).alias("counter"), F.col(name).alias("value")) for name in wide.columns])
        return wide.select(F.explode(pairs).alias("pair")).select("pair.*")

    counters = as_rows(of_orders)
    for wide in (of_states, unmatched, of_buckets):
        counters = counters.unionByName(as_rows(wide))
    return counters.orderBy("counter")


class ObservedWinners:
    """``winning_category`` with the counters of ``quality_counters`` taken by the run that writes it.

    ``winners`` is the result. Once an action on it is done, ``counters()`` gives what that
    run saw, without making the buckets again; only the staged daily sums are read for the rest.
    """

    def __init__(
        self,
        sales: DataFrame | None,
        threshold: int = BOUGHT_THRESHOLD,
        short: int = SHORT_WINDOW,
        long: int = LONG_WINDOW,
        daily: DataFrame | None = None,
        lengths: DataFrame | None = None,
    ):
        self._threshold = threshold
        self._daily, self._lengths, buckets = staged_windows(sales, threshold, short, long, daily, lengths)
        self._buckets, self._winners = Observation(), Observation()
        metrics = [metric.alias(name) for name, metric in _of_buckets().items()]
        # The result is counted behind its sort: Spark runs what is before twice, to find the sort's ranges.
        chosen = winners_of(buckets.observe(self._buckets, *metrics)).orderBy("state", "window_date")
        self.winners = chosen.observe(self._winners, F.count(F.lit(1)).alias("winners_selected"))

    def counters(self) -> DataFrame:
        """The (counter, value) rows of ``quality_counters``; waits for an action on ``winners``."""
        seen = self._buckets.get | self._winners.get
        names = [*_of_buckets(), "winners_selected"]
        schema = ", ".join(f"{name} bigint" for name in names)
        observed = self._daily.sparkSession.createDataFrame([tuple(seen[name] for name in names)], schema)
        return _all_counters(self._daily, self._lengths, self._threshold, observed)
