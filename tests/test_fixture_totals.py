"""Totals of the sf0.001 tables that were measured independently."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import sparksales as ss
from sparksales.sources.star_schema import ROW_KEY, raw_from_tables, sales_from_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sales(spark):
    return ss.stage(sales_from_tables(spark, FOLDER))


def test_rows(sales):
    assert sales.count() == sales.select(*ROW_KEY).distinct().count() == 6000
    assert sales.filter(F.col("amount").isNotNull()).count() == 5710


def test_winning_size(sales):
    assert ss.winning_category(sales, threshold=100).count() == 18439
    lengths = ss.state_window_length(ss.daily_summary(sales), threshold=100)
    assert lengths.filter("window_length = 5").count() == 19


def test_median_variety(sales):
    medians = ss.median_variety(sales)
    assert medians.count() == 1380
    assert medians.filter(F.col("median_variety") != F.floor("median_variety")).count() == 73


def test_city_percentage(sales):
    report = ss.city_qualifying_pct(sales, row_key=ROW_KEY)
    totals = report.agg(F.count("city"), F.sum("cancelled_standard_order_count"), F.sum("qualifying_order_count"))
    assert totals.collect() == [(105, 789, 212)]
    assert ss.valid_promotions(sales, row_key=ROW_KEY).count() == 52
    assert ss.promotion_active_period(sales, row_key=ROW_KEY).count() == 1684


def test_threshold_deviation(sales):
    by_brand = sales.withColumn("sku", F.col("style"))
    results = ss.threshold_stddev(by_brand, row_key=ROW_KEY)
    assert results.count() == 4 * 1907
    assert results.filter("amount_stddev_pop < 0 OR qualifying_order_count < 1").count() == 0
    differ = {row["percentile_level"]: row["thresholds_different"] for row in ss.compare_threshold_methods(results).collect()}
    assert differ == {"P80": 1102, "P90": 1156, "ALL": 2258}
    orders = ss.promotion_orders(by_brand, row_key=ROW_KEY)
    assert ss.largest_group(orders, ["month", "sku"]).first()["largest_group_size"] == 11


def test_text_export_gives_the_same_results(spark, sales, tmp_path):
    """Through raw text columns, CSV files and parsing; dates move to 20yy."""
    target = str(tmp_path / "export")
    ss.write_result(raw_from_tables(spark, FOLDER), target)
    parsed = ss.typed_sales(ss.read_sales_csv(spark, target))
    assert sorted(ss.state_reference_avg(parsed).collect()) == sorted(ss.state_reference_avg(sales, ROW_KEY).collect())
    assert ss.city_qualifying_pct(parsed).collect() == ss.city_qualifying_pct(sales, row_key=ROW_KEY).collect()
    direct = ss.winning_category(sales, threshold=100).drop("window_date", "state").collect()
    assert sorted(map(str, ss.winning_category(parsed, threshold=100).drop("window_date", "state").collect())) == sorted(map(str, direct))
