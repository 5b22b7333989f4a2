from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

import reference_rows
import sparksales as ss
from helpers import DEFAULTS, day, sales_frame

CANCELLED = dict(status="Cancelled", fulfilment="Amazon", promotion_ids="A,B,C", amount=50.0)


def lasting(*ids, **row):
    """Two rows that make the ids last two days, priced 100."""
    return [dict(promotion_ids=",".join(ids), order_date=day(text), **row) for text in ("2022-04-01", "2022-04-03")]


def percentages(spark, rows, **options):
    got = ss.city_qualifying_pct(sales_frame(spark, rows), **options).collect()
    return {row["city"]: tuple(row)[1:] for row in got}


def test_lifetime_of_promotions(spark):
    rows = [
        dict(promotion_ids="one day", order_date=day("2022-04-01")),
        dict(promotion_ids="one day, two days", order_date=day("2022-04-02")),
        dict(promotion_ids="two days", order_date=day("2022-04-04")),
        dict(promotion_ids="never dated", order_date=None),
    ]
    sales = sales_frame(spark, rows)
    periods = {row["promotion_id"]: (str(row[1]), str(row[2])) for row in ss.promotion_active_period(sales).collect()}
    assert periods == {"one day": ("2022-04-01", "2022-04-02"), "two days": ("2022-04-02", "2022-04-04")}
    assert [row[0] for row in ss.valid_promotions(sales).collect()] == ["two days"]


def test_counts_per_row(spark):
    rows = lasting("A", "B") + [
        dict(CANCELLED, row_id=10, promotion_ids="A,A, ,B,short"),
        dict(CANCELLED, row_id=11, promotion_ids=None),
        dict(CANCELLED, row_id=12, promotion_ids="short", order_date=None),
        dict(CANCELLED, row_id=13, promotion_ids="B", order_date=None),
        dict(CANCELLED, row_id=None, promotion_ids="B"),
        dict(CANCELLED, row_id=14, service_level="Expedited"),
        dict(CANCELLED, row_id=15, city=""),
    ]
    frame = sales_frame(spark, rows)
    got = dict(tuple(row) for row in ss.valid_promotion_counts(frame).collect())
    ids = {row.row_id for row in frame.collect()} - {None}
    assert set(got) == ids
    assert {key: got[key] for key in range(10, 16)} == {10: 2, 11: 0, 12: 0, 13: 1, 14: 2, 15: 2}


def test_repeated_row_ids_count_together(spark):
    rows = lasting("A", "B", "C") + [
        dict(row_id=50, promotion_ids="A,B"),
        dict(CANCELLED, row_id=50, promotion_ids="A,B"),
        dict(CANCELLED, row_id=50, promotion_ids="C,short"),
        dict(CANCELLED, row_id=51, promotion_ids=None),
        dict(CANCELLED, row_id=51, promotion_ids="short"),
    ]
    got = [tuple(row) for row in ss.valid_promotion_counts(sales_frame(spark, rows)).collect()]
    assert (50, 3) in got and (51, 0) in got and len(got) == len({key for key, _ in got})


def test_reference_average(spark):
    rows = [
        dict(amount=10.1),
        dict(amount=10.3, fulfilment=" MERCHANT", courier_status="shipped "),
        dict(amount=None),
        dict(amount=99.0, courier_status="On the Way"),
        dict(amount=99.0, courier_status="Shipped - Delivered"),
        dict(amount=99.0, fulfilment="Amazon"),
        dict(amount=99.0, state=""),
        dict(amount=None, state="empty"),
    ]
    got = dict(tuple(row) for row in ss.state_reference_avg(sales_frame(spark, rows)).collect())
    assert got == {"TT": 10.2, "empty": None}


@pytest.mark.parametrize(
    "change, qualifies",
    [
        ({}, 1),
        (dict(amount=100.0), 0),
        (dict(amount=None), 0),
        (dict(amount=float("nan")), 0),
        (dict(state="unknown"), 0),
        (dict(state=None), 0),
        (dict(promotion_ids="A,B"), 0),
        (dict(promotion_ids="A,B,B,B"), 0),
        (dict(promotion_ids="A,B,short"), 0),
        (dict(promotion_ids=" C , A,B,short"), 1),
        (dict(promotion_ids=None), 0),
        (dict(order_date=None), 1),
    ],
)
def test_who_qualifies(spark, change, qualifies):
    rows = lasting("A", "B", "C") + [dict(CANCELLED, **{}) | change]
    assert percentages(spark, rows) == {"HUE": (1, qualifies, 100.0 * qualifies)}


def test_equal_to_the_average_does_not_qualify(spark):
    rows = lasting("A", "B", "C", amount=10.1) + [dict(amount=10.1)] * 5 + [dict(CANCELLED, amount=10.1)]
    assert percentages(spark, rows) == {"HUE": (1, 0, 0.0)}


def test_city_ignores_the_state(spark):
    rows = lasting("A", "B", "C") + lasting("D", amount=10.0, state="low")
    rows += [dict(CANCELLED), dict(CANCELLED, state="low"), dict(CANCELLED, city="VINH")]
    assert percentages(spark, rows) == {"HUE": (2, 1, 50.0), "VINH": (1, 1, 100.0)}


def test_parameters(spark):
    rows = lasting("A", "B", "C") + [dict(CANCELLED, promotion_ids="A,B", order_date=None)]
    assert percentages(spark, rows, min_promotions=2)["HUE"][1] == 1
    assert percentages(spark, rows, min_promotions=2, min_days=3)["HUE"][1] == 0
    rows += [dict(CANCELLED, promotion_ids=None), dict(CANCELLED, promotion_ids=None, amount=100.0)]
    assert percentages(spark, rows, min_promotions=0)["HUE"][:2] == (3, 2)


def random_rows(seed, hot):
    rng = random.Random(seed)
    ids = [f"p{number}" for number in range(12)]
    rows = []
    for _ in range(500):
        chosen = rng.choices(ids, k=rng.randrange(7)) + (["hot"] if rng.random() < hot else [])
        start = date(2022, 3, 1)
        rows.append(
            dict(
                DEFAULTS,
                order_date=rng.choice([None, start, start + timedelta(days=1), start + timedelta(days=rng.randrange(9))]),
                promotion_ids=rng.choice([", ", ","]).join(chosen),
                status=rng.choice(["Cancelled", "CANCELLED", "Shipped"]),
                service_level=rng.choice(["Standard", "Expedited"]),
                fulfilment=rng.choice(["Merchant", "Amazon"]),
                courier_status=rng.choice(["Shipped", "Unshipped"]),
                city="hot" if rng.random() < hot else rng.choice(["x", "y", "z"]),
                state=rng.choice(["a", "b", "c"]),
                amount=rng.choice([None, 10.1, 20.2, 30.3, 40.45]),
            )
        )
    return rows


@pytest.mark.parametrize("seed, hot", [(1, 0.0), (2, 0.5), (3, 0.9)])
def test_against_row_by_row_definition(spark, seed, hot):
    rows = random_rows(seed, hot)
    assert percentages(spark, rows) == reference_rows.city_percentages(rows)


@pytest.mark.parametrize("repeated_bytes", [0, 64 * 1024**3])
def test_other_join_paths_give_the_same(spark, monkeypatch, repeated_bytes):
    rows = random_rows(4, 0.6)
    rows += [dict(row, state="TT", city="TT") for row in rows]
    monkeypatch.setattr(ss.lookup_join, "__defaults__", ("inner", 0, repeated_bytes))
    assert percentages(spark, rows) == reference_rows.city_percentages(rows)
    import test_winning_size as sizes

    orders = sizes.random_rows(6, 300, 0.5)
    expected = reference_rows.winners(orders, threshold=60)
    got = ss.winning_category(sales_frame(spark, orders), threshold=60).collect()
    assert {(r["state"], r["window_date"]): r["winning_size"] for r in got} == {k: v[0] for k, v in expected.items()}
    counters = {r["counter"]: r["value"] for r in ss.quality_counters(sales_frame(spark, orders), threshold=60).collect()}
    assert counters["missing_state_window"] == 0
