from __future__ import annotations

import random
import statistics
from collections import defaultdict
from datetime import date, timedelta

import pytest

import sparksales as ss
from helpers import day, sales_frame


def styles(varieties, **common):
    """One plus-size style per entry with that many SKUs."""
    return [
        dict(style=f"style {number}", sku=f"sku {number}/{item}", size="XXL", **common)
        for number, variety in enumerate(varieties)
        for item in range(variety)
    ]


@pytest.mark.parametrize("varieties, median", [([1, 2, 4], 2.0), ([1, 2, 4, 5], 3.0), ([3, 4], 3.5), ([7], 7.0)])
def test_median(spark, varieties, median):
    assert ss.median_variety(sales_frame(spark, styles(varieties))).collect() == [("2022-04", "TT", median)]


@pytest.mark.parametrize("sizes, kept", [(["3XL"], True), (["xxl"], True), (["XL"], False), (["weird"], False), (["S", "6XL", "?"], True)])
def test_which_styles_qualify(spark, sizes, kept):
    rows = [dict(size=size, sku=f"sku {size}") for size in sizes]
    got = ss.style_variety(sales_frame(spark, rows)).collect()
    assert [row["variety"] for row in got] == ([len(sizes)] if kept else [])


def test_states_merge_by_case_and_status_plays_no_part(spark):
    rows = [
        dict(state=" goa ", sku="1", size="XXL", status="Cancelled", qty=0),
        dict(state="GOA", sku="2", size="S"),
        dict(state="GOA", sku="2", size="S"),
    ]
    (row,) = ss.style_variety(sales_frame(spark, rows)).collect()
    assert (row["state"], row["variety"], row["max_size_rank"]) == ("GOA", 2, 6)


def test_rows_missing_a_field_are_left_out(spark):
    rows = [dict(size="XXL", **{name: value}) for name in ("style", "sku", "state") for value in (None, "")]
    rows += [dict(size=""), dict(size=None), dict(size="XXL", order_date=None)]
    assert ss.style_variety(sales_frame(spark, rows)).count() == 0


def test_ordered_by_month_and_state(spark):
    rows = styles([1], order_date=day("2022-05-01"), state="A") + styles([1], state="B") + styles([1], state="A")
    got = [(row["month"], row["state"]) for row in ss.median_variety(sales_frame(spark, rows)).collect()]
    assert got == [("2022-04", "A"), ("2022-04", "B"), ("2022-05", "A")]


def test_against_row_by_row_definition(spark):
    rng = random.Random(4)
    rows = [
        dict(
            order_date=date(2022, 3, 1) + timedelta(days=rng.randrange(90)),
            state=rng.choice(["Goa", "GOA", "Bihar"]),
            style="hot" if rng.random() < 0.4 else f"st{rng.randrange(12)}",
            sku=f"s{rng.randrange(60)}",
            size=rng.choice(list(ss.SIZE_RANKS) + ["odd"]),
        )
        for _ in range(700)
    ]
    skus, ranks = defaultdict(set), defaultdict(lambda: -1)
    for row in rows:
        key = (row["order_date"].strftime("%Y-%m"), row["state"].upper(), row["style"])
        skus[key].add(row["sku"])
        ranks[key] = max(ranks[key], ss.SIZE_RANKS.get(row["size"], -1))
    varieties = defaultdict(list)
    for key, found in skus.items():
        if ranks[key] >= 6:
            varieties[key[:2]].append(len(found))
    expected = sorted((*key, float(statistics.median(values))) for key, values in varieties.items())
    assert [tuple(row) for row in ss.median_variety(sales_frame(spark, rows)).collect()] == expected
