"""Trailing calendar windows whose length is a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def trailing_day_buckets(df: DataFrame, date: str, length: str, bucket: str = "window_date") -> DataFrame:
    """Give each row to every day whose window ``[day - length, day - 1]`` covers its date.

    Days without rows of their own still get a bucket, which a range frame over
    existing rows could not produce. The fan-out is ``length``, so aggregate to one
    row per day first.
    """
    return (
        df.withColumn("days_later", F.explode(F.sequence(F.lit(1), F.col(length))))
        .withColumn(bucket, F.date_add(F.col(date), F.col("days_later")))
        .drop(date, "days_later")
    )
