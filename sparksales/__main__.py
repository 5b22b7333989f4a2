"""Run one analysis over a sales CSV: ``python -m sparksales JOB INPUT OUTPUT``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from . import operators, plans
from .operators import stage, staging_scope
from .sources import read_sales_csv, typed_sales, write_result


@dataclass(frozen=True)
class Job:
    build: Callable[[DataFrame], DataFrame]
    format: str
    order_by: tuple[str, ...]
    scans: int = 1


def _compare(sales: DataFrame) -> DataFrame:
    return plans.compare_threshold_methods(plans.threshold_stddev(sales))


def _largest_group(sales: DataFrame) -> DataFrame:
    return operators.largest_group(plans.promotion_orders(sales), ["month", "sku"])


JOBS = {
    "winning-size": Job(plans.winning_category, "csv", ("state", "window_date")),
    "median-variety": Job(plans.median_variety, "csv", ("month", "state")),
    "city-percentage": Job(plans.city_qualifying_pct, "parquet", ("city",), scans=3),
    "threshold-deviation": Job(plans.threshold_stddev, "parquet", ("month", "sku", "method", "percentile_level")),
    "compare-methods": Job(_compare, "csv", ("percentile_level",)),
    "quality-counters": Job(plans.quality_counters, "csv", ("counter",)),
    "largest-group": Job(_largest_group, "csv", ()),
    "row-count": Job(operators.row_count, "csv", ()),
}


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sparksales", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("input", help="CSV file or folder")
    parser.add_argument("output", help="must not exist")
    parser.add_argument("--format", choices=["csv", "parquet"], help="default: the job's own")
    parser.add_argument("--single-file", action="store_true", help="write one sorted file instead of a folder")
    parser.add_argument("--single-file-bytes", type=int, help="refuse a larger single file; default: no limit")
    parser.add_argument("--clamp-days", action="store_true", help="read 02-30-22 as the last day of the month")
    parser.add_argument("--explain", action="store_true", help="print the plan first, of what follows the staged relations")
    options = parser.parse_args(arguments)
    job = JOBS[options.job]

    running = SparkSession.getActiveSession()
    spark = running or SparkSession.builder.appName(f"sparksales {options.job}").getOrCreate()
    try:
        with staging_scope(spark):
            sales = typed_sales(read_sales_csv(spark, options.input), clamp_days=options.clamp_days)
            if job.scans > 1:
                # Parse the text once; later scans then read a few columns each.
                sales = stage(sales)
            result = job.build(sales)
            if options.explain:
                result.explain(extended=True)
            write_result(
                result,
                options.output,
                options.format or job.format,
                options.single_file,
                job.order_by,
                options.single_file_bytes,
            )
    finally:
        if running is None:
            spark.stop()


if __name__ == "__main__":
    main()
