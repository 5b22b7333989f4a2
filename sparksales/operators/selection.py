"""Exact percentiles of wide values, by narrowing the range that holds each wanted rank.

A histogram of every value (``percentiles``) is as large as the table where values hardly repeat.
Here a group's range is cut into ``BUCKETS`` equal parts, rows are counted per part before anything
moves, and only the part with the wanted rank is cut again, from its own smallest to its own
largest value. A round reads the values once and shuffles at most ``BUCKETS`` counts per range and
task; after it, a range holds a small share of its rows. Ranges with one value, or with at most ``SMALL``
rows, are read off. No group is ever sorted, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import finite_or_null
from .joins import lookup_join
from .percentiles import DEFAULT_LEVELS
from .staging import stage, stage_lookup

BUCKETS = 1024
SMALL = 1000


def _bucket(value: Column, low: Column, high: Column, buckets: int) -> Column:
    """Number of the equal part of [low, high] that holds the value; grows with it, first and last always differ."""
    # Halves, because the difference of two doubles may not be one.
    width = high / 2 - low / 2
    part = F.floor((value / 2 - low / 2) / width * buckets)
    return F.when(width > 0, F.least(part, F.lit(buckets - 1))).otherwise(F.when(value > low, buckets - 1).otherwise(0))


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    levels: Mapping[str, float] = DEFAULT_LEVELS,
    buckets: int = BUCKETS,
    small: int = SMALL,
) -> DataFrame:
    """(keys, percentile_level, percentile, threshold) per group, interpolated between the two nearest ranks.

    Null and non-finite values count nowhere, nor do rows with a null key; a group
    without values has no rows. Each round is staged.
    """
    if buckets < 2 or small < 1:
        raise ValueError("it takes at least two buckets and one row")
    keys, known = list(keys), F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    number = finite_or_null(F.col(value).cast("double"))
    values = stage(df.filter(known).select(*keys, number.alias("v")).filter(F.col("v").isNotNull()))

    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("percentile_level"), F.lit(float(p)).alias("percentile")) for name, p in levels.items()]))
    groups = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    at = (F.col("n") - 1).cast("double") * F.col("percentile")
    sides = F.explode(F.array(F.floor("at"), F.ceil("at")))
    targets = (
        groups.select("*", wanted.alias("level")).select("*", "level.*").withColumn("at", at)
        .select(*keys, "percentile_level", "percentile", "at", "n", "low", "high", F.lit(0).cast("bigint").alias("before"), sides.alias("rank"))
        .distinct()
    )
    targets = stage_lookup(targets)

    ranged = [*keys, "low", "high"]
    finished = []
    wide = (F.col("low") < F.col("high")) & (F.col("n") > small)
    while True:
        finished.append(targets.filter(~wide))
        targets = targets.filter(wide)
        if targets.limit(1).count() == 0:
            break
        inside = _inside(values, targets, keys)
        counts = inside.groupBy(*ranged, _bucket(F.col("v"), F.col("low"), F.col("high"), buckets).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n_inside"), F.min("v").alias("first"), F.max("v").alias("last")
        )
        earlier = Window.partitionBy(*ranged).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("n_before", F.coalesce(F.sum("n_inside").over(earlier), F.lit(0)))
        position = F.col("rank") - F.col("before") - F.col("n_before")
        found = targets.join(counts, ranged).filter((position >= 0) & (position < F.col("n_inside")))
        targets = stage_lookup(
            found.select(
                *keys, "percentile_level", "percentile", "at", F.col("n_inside").alias("n"), F.col("first").alias("low"),
                F.col("last").alias("high"), (F.col("before") + F.col("n_before")).alias("before"), "rank",
            )
        )

    done = finished[0]
    for more in finished[1:]:
        done = done.unionByName(more)
    done = stage_lookup(done)
    # At most ``small`` rows a range.
    listed = _inside(values, done.filter("low < high"), keys).groupBy(*ranged).agg(F.sort_array(F.collect_list("v")).alias("listed"))
    read = done.join(listed, ranged, "left").withColumn(
        "found", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.get("listed", (F.col("rank") - F.col("before")).cast("int")))
    )
    lower, upper = F.min("found"), F.max("found")
    share = F.max("at") - F.floor(F.max("at"))
    return read.groupBy(*keys, "percentile_level", "percentile").agg((lower + share * (upper - lower)).alias("threshold"))


def _inside(values: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """The values inside the ranges of ``targets``, once for each different range."""
    ranges = targets.groupBy(*keys).agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    near = lookup_join(values, stage_lookup(ranges), keys, ["v"])
    hit = F.filter("ranges", lambda r: (F.col("v") >= r["low"]) & (F.col("v") <= r["high"]))
    return near.select(*keys, "v", F.explode(hit).alias("range")).select(*keys, "v", "range.low", "range.high")
