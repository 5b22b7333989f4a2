from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import reference_rows
import sparksales as ss
from helpers import DEFAULTS, day, dicts, sales_frame


def win(spark, rows, **options):
    return {
        (row["state"], str(row["window_date"])): row for row in ss.winning_category(sales_frame(spark, rows), **options).collect()
    }


def test_what_counts_as_bought(spark):
    rows = [
        dict(sku="kept", status="  sHiPPed - Delivered"),
        dict(sku="returned", qty=-1),
        dict(sku="no amount", amount=None),
        dict(sku="none", qty=0),
        dict(qty=None),
        dict(status="Cancelled"),
        dict(status=None),
        dict(state=""),
        dict(state=None),
        dict(size=""),
        dict(order_date=None),
    ]
    assert ss.bought_by_state(sales_frame(spark, rows)).collect() == [("TT", 3)]


def test_state_names_keep_their_case(spark):
    rows = [dict(state="Bihar"), dict(state="BIHAR"), dict(state="BIHAR")]
    assert sorted(ss.bought_by_state(sales_frame(spark, rows)).collect()) == [("BIHAR", 2), ("Bihar", 1)]


@pytest.mark.parametrize("orders, days", [(10, 10), (11, 5)])
def test_window_covers_the_following_days_only(spark, orders, days):
    got = win(spark, [{}] * orders, threshold=10)
    start = day("2022-04-30")
    assert set(got) == {("TT", str(start + timedelta(days=later))) for later in range(1, days + 1)}
    assert {(row["winning_size"], row["purchase_count"], row["window_length"]) for row in got.values()} == {("M", orders, days)}


def test_default_threshold_edge(spark):
    totals = spark.createDataFrame([("a", 10000), ("b", 10001)], "state string, purchase_count bigint")
    lengths = {row["state"]: row["window_length"] for row in ss.state_window_length(totals).collect()}
    assert lengths == {"a": 10, "b": 5}


@pytest.mark.parametrize(
    "orders, expected",
    [
        ([("S", 1.0), ("S", 9.0), ("M", 5.0)], "S"),
        ([("S", 1.0), ("S", 9.0), ("M", 5.0), ("M", 6.0)], "M"),
        ([("S", None), ("M", 5.0)], "M"),
        ([("L", 3.0), ("M", 5.0)], "L"),
        ([("S", None), ("M", None)], "M"),
        ([("XL", 0.1), ("XL", 0.2), ("XL", 0.3), ("L", 0.1), ("L", 0.2), ("L", 0.3)], "L"),
    ],
)
def test_ties(spark, orders, expected):
    got = win(spark, [dict(size=size, amount=amount) for size, amount in orders])
    assert {row["winning_size"] for row in got.values()} == {expected}


def test_missing_amounts_count_but_do_not_vary(spark):
    rows = [dict(amount=None), dict(amount=float("nan")), dict(amount=1.0), dict(amount=3.0)]
    (row, *_) = dicts(ss.window_bucket_summary(sales_frame(spark, rows)))
    assert (row["purchase_count"], row["amount_count"], row["sum_amount"], row["population_variance"]) == (4, 2, 4.0, 1.0)
    assert row["sum_amount_squared"] == 10.0


def test_overflowing_variance_is_reported_and_skipped(spark):
    rows = [dict(size="S", amount=1e200), dict(size="S", amount=-1e200), dict(size="M", amount=1.0)]
    sales = sales_frame(spark, rows)
    assert {row["winning_size"] for row in ss.winning_category(sales).collect()} == {"M"}
    counters = {row["counter"]: row["value"] for row in ss.quality_counters(sales).collect()}
    assert (counters["malformed_buckets"], counters["winners_selected"], counters["candidates"]) == (10, 10, 20)


def test_equal_amounts_tie_in_every_partitioning(spark):
    rng = random.Random(11)
    amounts = [rng.uniform(1e7, 9e7) for _ in range(200)]
    rows = [dict(size=size, amount=amount) for size in ("B", "A") for amount in rng.sample(amounts, 200)]
    found = set()
    for parts in (1, 3, 7):
        sales = sales_frame(spark, rows).repartition(parts)
        found |= {(row["winning_size"], row["population_variance"]) for row in ss.winning_category(sales).collect()}
    assert len(found) == 1 and found.pop()[0] == "A"


def random_rows(seed, count, hot):
    rng = random.Random(seed)
    return [
        dict(
            DEFAULTS,
            state="hot" if rng.random() < hot else rng.choice(["a", "b", "c"]),
            order_date=date(2022, 3, 1) + timedelta(days=rng.randrange(40)),
            size=rng.choice(["S", "M", "L", "XL", "Free"]),
            status=rng.choice(["Shipped", "SHIPPED - x", "Cancelled"]),
            qty=rng.choice([0, 1, 1, 2]),
            amount=rng.choice([None, 10.1, 10.1, 20.25, 399.0, 0.07]),
        )
        for _ in range(count)
    ]


@pytest.mark.parametrize("seed, hot", [(1, 0.0), (2, 0.4), (3, 0.9)])
def test_against_row_by_row_definition(spark, seed, hot):
    rows = random_rows(seed, 400, hot)
    expected = reference_rows.winners(rows, threshold=60)
    got = ss.winning_category(sales_frame(spark, rows), threshold=60).collect()
    assert len(got) == len(expected)
    for row in got:
        size, count, variance, length = expected[row["state"], row["window_date"]]
        assert (row["winning_size"], row["purchase_count"], row["window_length"]) == (size, count, length)
        if variance is None:
            assert row["population_variance"] is None
        else:
            assert row["population_variance"] == pytest.approx(float(variance), rel=1e-12, abs=1e-12)
    assert [(row["state"], row["window_date"]) for row in got] == sorted(expected)


def test_counters_reconcile(spark):
    rows = random_rows(5, 300, 0.5)
    sales = sales_frame(spark, rows)
    counters = {row["counter"]: row["value"] for row in ss.quality_counters(sales, threshold=60).collect()}
    assert counters["buckets_emitted"] == counters["buckets_expected"] > 0
    assert counters["winners_selected"] == ss.winning_category(sales, threshold=60).count()
    assert counters["candidates"] == ss.window_bucket_summary(sales, threshold=60).count()
    assert counters["bought_orders_without_amount"] == ss.bought_orders(sales).filter(F.col("amount").isNull()).count()
    assert counters["missing_state_window"] == counters["malformed_buckets"] == 0


def test_the_run_itself_counts(spark, tmp_path):
    sales = sales_frame(spark, [*random_rows(6, 300, 0.5), dict(size="S", state="z", amount=1e200), dict(size="S", state="z", amount=-1e200)])
    run = ss.ObservedWinners(sales, threshold=60)
    ss.write_result(run.winners, str(tmp_path / "winners"), "parquet")
    rows = sorted(ss.quality_counters(sales, threshold=60).collect())
    assert sorted(run.counters().collect()) == rows
    assert sorted(spark.read.parquet(str(tmp_path / "winners")).collect()) == sorted(ss.winning_category(sales, threshold=60).collect())
    assert dict(rows)["malformed_buckets"] == 10
    nothing = ss.ObservedWinners(sales_frame(spark, [dict(status="Cancelled")]))
    assert nothing.winners.collect() == []
    assert {row["value"] for row in nothing.counters().collect()} == {0}


def test_given_window_lengths_may_lack_a_state(spark):
    sales = sales_frame(spark, [dict(state="A"), dict(state="A"), dict(state="B")])
    daily = ss.stage(ss.daily_summary(sales))
    lengths = ss.state_window_length(daily, threshold=60).filter("state = 'A'")
    counters = {row["counter"]: row["value"] for row in ss.quality_counters(None, daily=daily, lengths=lengths).collect()}
    assert (counters["missing_state_window"], counters["bought_orders"]) == (1, 3)
    assert counters["buckets_emitted"] == counters["buckets_expected"] == 20
    assert ss.winning_category(None, daily=daily).count() == 20


def test_counters_of_nothing(spark):
    counters = ss.quality_counters(sales_frame(spark, [dict(status="Cancelled")]))
    assert {row["value"] for row in counters.collect()} == {0}
