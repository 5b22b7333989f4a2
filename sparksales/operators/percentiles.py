"""Per-group percentiles of a small-integer column, from its value histogram.

Rows collapse to one line per (group, value) before anything is ordered, so a
group holding a third of all rows costs no more than its number of distinct
values. Positions are then read off the running row count.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

METHODS = ("approx", "exact")
DEFAULT_LEVELS = {"P80": 0.8, "P90": 0.9}
DEFAULT_ACCURACY = 10000
LARGEST_SKETCH = 65535
SALTS = 32


def count_histogram(df: DataFrame, keys: Sequence[str], value: str, extra: Sequence[Column] = ()) -> DataFrame:
    """One row per (group, value) with ``row_count`` and any further aggregates."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("row_count"), *extra)


def with_percentiles(
    histogram: DataFrame,
    keys: Sequence[str],
    value: str,
    levels: Mapping[str, float] = DEFAULT_LEVELS,
    methods: Sequence[str] = METHODS,
) -> DataFrame:
    """Append ``thresholds`` (one struct per method and level) and ``last_in_group``.

    * ``exact``: linear interpolation between the values at positions floor(h) and
      ceil(h) of the sorted rows, h = (n - 1) * p.
    * ``approx``: the value at rank ceil(n * p). This is what ``percentile_approx``
      answers while its sketch holds every row, and is within its promised rank
      error for any accuracy beyond that.

    All windows share one partitioning and one sort.
    """
    unknown = set(methods) - set(METHODS)
    if unknown or not methods:
        raise ValueError(f"methods must be some of {METHODS}, got {list(methods)}")
    ordered = Window.partitionBy(*keys).orderBy(value)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = histogram.withColumn(
        "rows_so_far", F.sum("row_count").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("rows_in_group", F.sum("row_count").over(whole))

    def value_at(position: Column) -> Column:
        return F.min(F.when(F.col("rows_so_far") >= position, F.col(value).cast("double"))).over(whole)

    rows = F.col("rows_in_group").cast("double")
    thresholds = []
    for method in METHODS:
        for label, p in levels.items():
            if method not in methods:
                continue
            if method == "approx":
                threshold = value_at(F.greatest(F.ceil(rows * F.lit(p)), F.lit(1)))
            else:
                h = (rows - 1.0) * F.lit(p)
                lower, upper = value_at(F.floor(h) + 1), value_at(F.ceil(h) + 1)
                threshold = lower + (h - F.floor(h)) * (upper - lower)
            thresholds.append(
                F.struct(
                    F.lit(method).alias("method"),
                    F.lit(label).alias("percentile_level"),
                    F.lit(float(p)).alias("percentile"),
                    threshold.alias("threshold"),
                )
            )
    return (
        ranked.withColumn("thresholds", F.array(*thresholds))
        .withColumn("last_in_group", F.col("rows_so_far") == F.col("rows_in_group"))
        .drop("rows_so_far", "rows_in_group")
    )


def sketch_size(accuracy: int) -> int:
    """The k of a KLL sketch whose rank error is about 1 / ``accuracy``; at most what Spark allows."""
    if accuracy < 1:
        raise ValueError(f"accuracy must be positive, got {accuracy}")
    return max(8, min(LARGEST_SKETCH, math.ceil((2.296 * accuracy) ** (1 / 0.9021))))


def task_salt() -> Column:
    """A number that spreads what tasks send over ``SALTS`` receivers; a retried task picks the same one."""
    return F.pmod(F.spark_partition_id(), F.lit(SALTS))


def sketch_quantiles(
    sketches: DataFrame, keys: Sequence[str], sketch: str, levels: Mapping[str, float] = DEFAULT_LEVELS
) -> DataFrame:
    """(keys, method, percentile_level, percentile, threshold) of merged sketches; null for empty ones."""
    n = F.kll_sketch_get_n_bigint(sketch)
    per_level = F.array(
        *[
            F.struct(
                F.lit(label).alias("percentile_level"),
                F.lit(float(p)).alias("percentile"),
                F.when(n > 0, F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(p)))).cast("double").alias("threshold"),
            )
            for label, p in levels.items()
        ]
    )
    return sketches.withColumn("level", F.explode(per_level)).select(*keys, F.lit("approx").alias("method"), "level.*")


def approx_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    levels: Mapping[str, float] = DEFAULT_LEVELS,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """Sketch form straight over rows: mergeable KLL sketches, one output row per group and level.

    Each task ships one sketch of bounded size per group. They are merged in two levels: by
    group and a salt of the task, then by group, so no task merges more than its share of a hot
    group's sketches, and then ``SALTS``. A sketch answers exactly until a group outgrows it; beyond
    that the rank error is about 1 / ``accuracy``, and two runs may differ within it. Use it
    for domains too wide for ``count_histogram``.
    """
    size = sketch_size(accuracy)
    salted = df.select(*keys, value, task_salt().alias("task_salt")).groupBy(*keys, "task_salt")
    sketches = salted.agg(F.kll_sketch_agg_bigint(value, F.lit(size)).alias("sketch"))
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch", F.lit(size)).alias("sketch"))
    return sketch_quantiles(merged, keys, "sketch", levels)
