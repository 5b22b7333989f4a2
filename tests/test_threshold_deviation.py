from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import reference_rows
import sparksales as ss
from helpers import DEFAULTS, dicts, sales_frame


def with_counts(counts, **row):
    return [dict(promotion_ids=",".join(["P"] * count), **row) for count in counts]


def by_key(df):
    return {(row["month"], row["sku"], row["method"], row["percentile_level"]): row for row in df.collect()}


def test_known_percentiles(spark):
    orders = ss.promotion_orders(sales_frame(spark, with_counts([0, 9, 0, 1, 0, 2, 0, 2, 5, 3])))
    got = {key[2:]: row["promotion_threshold"] for key, row in by_key(ss.thresholds(orders)).items()}
    assert got["approx", "P80"] == 3.0 and got["approx", "P90"] == 5.0
    assert got["exact", "P80"] == pytest.approx(3.4) and got["exact", "P90"] == pytest.approx(5.4)


def test_result_shape(spark):
    rows = with_counts([0, 1, 2], sku="a") + with_counts([4], sku="b") + [dict(sku=""), dict(sku=None), dict(order_date=None)]
    rows += [dict(row_id=None)]
    result = ss.threshold_stddev(sales_frame(spark, rows))
    assert result.columns == [
        "month",
        "sku",
        "method",
        "percentile_level",
        "percentile",
        "promotion_threshold",
        "qualifying_order_count",
        "amount_stddev_pop",
    ]
    got = dicts(result)
    assert len(got) == 8 and {row["sku"] for row in got} == {"a", "b"}
    assert all(value is not None for row in got for value in row.values())
    keys = [(row["month"], row["sku"], row["method"], row["percentile_level"]) for row in got]
    assert keys == sorted(set(keys))


@pytest.mark.parametrize("amounts, rows, deviation", [([7.0], 1, 0.0), ([None, None], 2, 0.0), ([5.0, None], 2, 0.0), ([1.0, 3.0], 2, 1.0)])
def test_deviation_guards(spark, amounts, rows, deviation):
    got = dicts(ss.threshold_stddev(sales_frame(spark, [dict(amount=amount) for amount in amounts])))
    assert {(row["qualifying_order_count"], row["amount_stddev_pop"]) for row in got} == {(rows, deviation)}


def random_rows(seed, count=600, hot=0.4):
    rng = random.Random(seed)
    return [
        dict(
            DEFAULTS,
            sku="hot" if rng.random() < hot else f"s{rng.randrange(25)}",
            order_date=date(2022, 3, 1) + timedelta(days=rng.randrange(90)),
            promotion_ids=",".join(rng.choices(["P", " Q", "", "R "], k=rng.choice([0, 0, 1, 2, 3, 5, 8, 40]))),
            amount=rng.choice([None, 10.1, 20.25, 399.0, round(rng.random() * 1000, 2)]),
        )
        for _ in range(count)
    ]


@pytest.mark.parametrize("levels", [{"P80": 0.8, "P90": 0.9}, {"P0": 0.0, "P50": 0.5, "P100": 1.0}])
def test_against_row_by_row_definition(spark, levels):
    rows = random_rows(7)
    expected = reference_rows.deviations(rows, levels)
    got = by_key(ss.threshold_stddev(sales_frame(spark, rows), levels=levels))
    assert set(got) == set(expected)
    for key, (threshold, count, deviation) in expected.items():
        row = got[key]
        assert (row["promotion_threshold"], row["qualifying_order_count"]) == (threshold, count)
        assert row["amount_stddev_pop"] == pytest.approx(deviation, rel=1e-9, abs=1e-9)


def test_histogram_and_sketch_agree(spark):
    orders = ss.promotion_orders(sales_frame(spark, random_rows(8, 1500)))
    histogram, sketch = ss.thresholds(orders, methods=["approx"]), ss.approx_thresholds(orders)
    assert histogram.columns == sketch.columns
    assert sorted(histogram.collect()) == sorted(sketch.collect())


def test_thresholds_from_elsewhere(spark):
    sales = sales_frame(spark, random_rows(9))
    orders = ss.promotion_orders(sales)
    given = ss.deviation_above_thresholds(orders, ss.approx_thresholds(orders))
    assert sorted(given.collect()) == sorted(ss.threshold_stddev(sales, methods=["approx"]).collect())


def test_methods_are_checked(spark):
    with pytest.raises(ValueError, match="methods"):
        ss.threshold_stddev(sales_frame(spark, [{}]), methods=["guess"])


def test_comparison(spark):
    rows = random_rows(10)
    results = ss.threshold_stddev(sales_frame(spark, rows))
    expected = reference_rows.deviations(rows, {"P80": 0.8, "P90": 0.9})
    got = {row["percentile_level"]: row for row in ss.compare_threshold_methods(results).collect()}
    assert list(got) == ["ALL", "P80", "P90"]
    for level in ("P80", "P90", "ALL"):
        pairs = [
            (value, expected[month, sku, "exact", label])
            for (month, sku, method, label), value in expected.items()
            if method == "approx" and level in (label, "ALL")
        ]
        row = got[level]
        assert row["comparisons"] == len(pairs)
        assert row["thresholds_different"] == sum(a[0] != e[0] for a, e in pairs) > 0
        assert row["qualifying_sets_different"] == sum(a[1] != e[1] for a, e in pairs) > 0
        assert row["mean_threshold_difference"] == pytest.approx(sum(abs(a[0] - e[0]) for a, e in pairs) / len(pairs))
        assert row["max_stddev_difference"] == pytest.approx(max(abs(a[2] - e[2]) for a, e in pairs))


def test_comparison_needs_both_methods(spark):
    results = ss.threshold_stddev(sales_frame(spark, random_rows(11, 100))).filter((F.col("method") == "exact") | (F.col("sku") == "hot"))
    row = ss.compare_threshold_methods(results).filter("percentile_level = 'P80'").first()
    assert row["comparisons"] == results.filter("sku = 'hot' AND method = 'approx' AND percentile_level = 'P80'").count()


def test_group_sizes(spark):
    orders = ss.promotion_orders(sales_frame(spark, [dict(sku="a")] * 3 + [dict(sku="b")]))
    assert ss.largest_group(orders, ["month", "sku"]).collect() == [(2, 3, False)]
    assert ss.largest_group(orders, ["month", "sku"], warn_above=2).collect() == [(2, 3, True)]
    assert ss.row_count(orders).collect() == [(4,)]


class TestAccuracy:
    def orders(self, count, hot=1 / 3):
        rng = random.Random(9)
        skus = ["hot" if rng.random() < hot else f"s{rng.randrange(40)}" for _ in range(count)]
        return [
            dict(sku=sku, amount=rng.choice([None, 5.0, 7.25, 100.5]), promotion_ids=",".join("p" * rng.randrange(60)) or None)
            for sku in skus
        ]

    def test_small_groups_are_answered_exactly(self, spark):
        sales = sales_frame(spark, self.orders(600)).repartition(5)
        expected = sorted(ss.threshold_stddev(sales).collect())
        assert sorted(ss.threshold_stddev(sales, accuracy=10_000).collect()) == expected
        approx = sorted(ss.threshold_stddev(sales, methods=("approx",)).collect())
        assert sorted(ss.threshold_stddev(sales, methods=("approx",), accuracy=500).collect()) == approx

    def test_rank_error(self, spark):
        # Wide values, far more of them than a sketch of this accuracy holds.
        df = spark.range(200_000, numPartitions=40).selectExpr("'g' AS g", "(id * 7919) % 200000 AS v")
        for accuracy in (50, 1000):
            for row in ss.approx_percentiles(df, ["g"], "v", accuracy=accuracy).collect():
                assert abs(row["threshold"] / 200_000 - row["percentile"]) < 3 / accuracy
        with pytest.raises(ValueError):
            ss.approx_percentiles(df, ["g"], "v", accuracy=0)

    def test_sketches_of_a_hot_group_are_merged_in_two_levels(self, spark):
        sales = sales_frame(spark, self.orders(50))
        text = ss.approx_percentiles(ss.promotion_orders(sales), ["month", "sku"], "promotion_count")._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 2 and "hashpartitioning(month" in text
        assert "task_salt" in text[text.rindex("Exchange hashpartitioning") :].splitlines()[0]
        assert text.count("Scan") == 1

    def test_wide_groups_are_staged_once(self, spark):
        sales = sales_frame(spark, self.orders(50))
        text = ss.threshold_stddev(sales, accuracy=100)._jdf.queryExecution().executedPlan().toString()
        assert "ExistingRDD" not in text and "FileScan parquet" in text
