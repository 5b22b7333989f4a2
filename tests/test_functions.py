from __future__ import annotations

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

import sparksales as ss


def evaluate(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(number, value) for number, value in enumerate(values)], f"n int, v {kind}")
    return [row[0] for row in df.orderBy("n").select(expression(F.col("v"))).collect()]


def test_bad_numbers_become_null(spark):
    texts = ["7", " -3\t", "abc", "1.0", "9999999999999999999", "", None]
    assert evaluate(spark, ss.parse_long, texts) == [7, -3, None, None, None, None, None]
    assert evaluate(spark, ss.parse_double, ["647.62", "x", "", None, " 1e2 "]) == [647.62, None, None, None, 100.0]


def test_finite_or_null(spark):
    values = [1.5, float("nan"), float("inf"), float("-inf"), None]
    assert evaluate(spark, ss.finite_or_null, values, "double") == [1.5, None, None, None, None]


def test_dates(spark):
    texts = ["04-30-22", " 04-30-99 ", "13-01-22", "4-30-22", "02-30-22", "04-31-22", "", None, "2022-04-30"]
    strict = [date(2022, 4, 30), date(2099, 4, 30)] + [None] * 7
    assert evaluate(spark, ss.parse_date, texts) == strict
    clamped = list(strict)
    clamped[4], clamped[5] = date(2022, 2, 28), date(2022, 4, 30)
    assert evaluate(spark, lambda text: ss.parse_date(text, clamp=True), texts) == clamped
    assert evaluate(spark, lambda text: ss.parse_date(text, clamp=True), ["02-29-24", "02-30-24", "04-32-22"]) == [
        date(2024, 2, 29),
        date(2024, 2, 29),
        None,
    ]


def test_month(spark):
    assert evaluate(spark, lambda d: ss.month_key(ss.month_start(d)), [date(2022, 4, 30), None], "date") == ["2022-04", None]


def test_clean_removes_control_characters(spark):
    assert evaluate(spark, ss.clean, ["\t a b \r\n", "\x00x\x1f", "", None]) == ["a b", "x", "", None]


def test_promotions(spark):
    texts = ["A,A, ,B", " B , A,B", "", None, ",,", "  ", " a b  c ,d\te, a b  c", "x ,\n, y"]
    assert evaluate(spark, ss.promotion_list, texts) == [
        ["A", "B"],
        ["B", "A"],
        [],
        [],
        [],
        [],
        ["a b  c", "d\te"],
        ["x", "\n", "y"],
    ]
    assert evaluate(spark, ss.promotion_count, texts) == [3, 3, 0, 0, 0, 0, 3, 3]


def test_size_ranks(spark):
    texts = ["Free", "xs", " XXL ", "3xl", "6XL", "weird", None]
    assert evaluate(spark, ss.size_rank, texts) == [0, 1, 6, 7, 10, -1, -1]


class TestMoments:
    moments = ss.Moments("amount")

    def summary(self, spark, groups):
        rows = [(key, value) for key, values in groups.items() for value in values]
        m = self.moments
        cut = m.cut(spark.createDataFrame(rows, "k string, v double"), F.col("v"), "k")
        parts = cut.groupBy("k", F.rand(1) > 0.5).agg(*m.first())
        merged = m.with_variance(parts.groupBy("k").agg(*m.again()), "variance")
        columns = [m.total(), m.total_squared(), m.mean(), F.col("variance"), F.sqrt("variance")]
        names = ["total", "squared", "mean", "variance", "deviation"]
        return {
            row["k"]: row
            for row in merged.select("k", *[column.alias(name) for column, name in zip(columns, names)]).collect()
        }

    def test_equal_amounts_have_exactly_no_variance(self, spark):
        row = self.summary(spark, {"a": [647.62] * 7})["a"]
        assert row["variance"] == 0.0 and row["mean"] == 647.62 and row["deviation"] == 0.0

    def test_nulls_and_empty_groups(self, spark):
        got = self.summary(spark, {"some": [None, 1.0, 3.0], "none": [None, None]})
        assert (got["some"]["mean"], got["some"]["variance"]) == (2.0, 1.0)
        assert (got["none"]["mean"], got["none"]["variance"], got["none"]["total"]) == (None, None, 0.0)

    @pytest.mark.parametrize("values", [[0.125, 0.5, 2.25], [1.005, 2.5, -3.25], [3e7, 1e7, 2e7], [-4.5, 4.5, 0.333]])
    def test_other_grids_fall_back(self, spark, values):
        row = self.summary(spark, {"a": values})["a"]
        mean = sum(values) / len(values)
        variance = sum((value - mean) ** 2 for value in values) / len(values)
        assert row["mean"] == pytest.approx(mean) and row["variance"] == pytest.approx(variance)
        assert row["total"] == pytest.approx(sum(values))
        assert row["squared"] == pytest.approx(sum(value * value for value in values))

    def test_large_and_negative_amounts_stay_exact(self, spark):
        got = self.summary(spark, {"a": [9999999.99, -9999999.99, -0.01, 0.01], "b": [-1234567.89] * 3})
        cents = [999999999, -999999999, -1, 1]
        assert (got["a"]["total"], got["a"]["mean"]) == (0.0, 0.0)
        assert got["a"]["squared"] == sum(value * value for value in cents) / 10000
        assert got["a"]["variance"] == sum(value * value for value in cents) * 4 / 16 / 10000
        assert (got["b"]["variance"], got["b"]["mean"]) == (0.0, -1234567.89)

    def test_not_a_number_spreads(self, spark):
        row = self.summary(spark, {"a": [1.0, float("nan")]})["a"]
        assert row["variance"] != row["variance"]

    @pytest.mark.parametrize("n", [2, 10**6, 10**12])
    @pytest.mark.parametrize("high, low", [(90_000_000_000, 10_000), (-5_000_000, 2_500_001), ((1 << 57) - 3, (1 << 57) - 1)])
    def test_merged_sums_of_any_number_of_rows_are_exact(self, spark, n, high, low):
        """Half of the amounts ``high``, half ``low`` ten-thousandths, as already merged sums."""
        m, base = self.moments, 1 << 20

        def limbs(units):
            sign, size = (units > 0) - (units < 0), abs(units)
            return [0, size % base * sign, size // base % base * sign, size // base**2 * sign]

        def products(a):
            a, b, c, d = a
            return [a * a, a * b, 2 * a * c + b * b, a * d + b * c, 2 * b * d + c * c, c * d, d * d]

        def half(values):
            return [n // 2 * value for value in values]

        def both(names, one, other):
            return dict(zip(names, [x + y for x, y in zip(half(one), half(other))], strict=True))

        one, other = products(limbs(high)), products(limbs(low))
        values = {m.count: n, m.far_count: 0} | both(m.sums, limbs(high), limbs(low))
        values |= both(m.low, [x % base for x in one], [x % base for x in other])
        values |= both(m.high, [x // base for x in one], [x // base for x in other])
        schema = ", ".join(f"{name} bigint" for name in values)
        df = spark.createDataFrame([tuple(values.values())], schema).withColumns({m.far_sum: F.lit(0.0), m.far_squares: F.lit(0.0)})
        (value,) = m.with_variance(df, "variance").select("variance").first()
        assert value == pytest.approx((high - low) ** 2 / 4 / 10**8, rel=1e-15)

    @pytest.mark.parametrize("base", [9e6, 12345678.0, 1e9, 1e10, 1e11])
    def test_small_spread_of_large_amounts(self, spark, base):
        row = self.summary(spark, {"a": [base + cents / 100 for cents in (10, 20, 30, 40)]})["a"]
        assert row["deviation"] == pytest.approx(0.1118033988749895, abs=1e-9 if base < 1e9 else 1e-5)
        assert base >= 1e11 or row["deviation"] == pytest.approx(0.1118033988749895, rel=1e-14)

    def test_off_grid_amounts_keep_their_spread(self, spark):
        values = [1e6 + x for x in (0.01, 0.02, 0.03, 0.04, 0.0412345)]
        mean = sum(v - 1e6 for v in values) / 5
        expected = (sum((v - 1e6 - mean) ** 2 for v in values) / 5) ** 0.5
        assert self.summary(spark, {"a": values})["a"]["deviation"] == pytest.approx(expected, rel=1e-6)
        far = self.summary(spark, {"a": [1e13 + x for x in (0, 1, 2, 3)]})["a"]
        assert far["deviation"] == pytest.approx(1.25**0.5)

    def over_partitions(self, df, parts):
        m = self.moments
        sums = m.cut(df.repartition(parts), F.col("v")).agg(*m.first())
        return m.with_variance(sums, "variance").select("variance", m.total()).first()

    def test_full_doubles_are_the_same_for_every_partitioning(self, spark):
        rng = random.Random(7)
        rows = [(rng.uniform(1e7, 9e7),) for _ in range(200)] + [(rng.uniform(-1, 1),) for _ in range(50)]
        df = spark.createDataFrame(rows, "v double")
        found = {self.over_partitions(df, parts) for parts in (1, 2, 3, 5, 7, 11)}
        mean = math.fsum(v for (v,) in rows) / 250
        assert len(found) == 1
        assert found.pop()[0] == pytest.approx(math.fsum((v - mean) ** 2 for (v,) in rows) / 250, rel=1e-14)

    def test_the_same_for_every_partitioning(self, spark):
        rows = [(float(10_000_000 + i * 399_999.37 % 80_000_000),) for i in range(200)]
        rows = [(round(value, 2),) for (value,) in rows]
        df, found = spark.createDataFrame(rows, "v double"), set()
        for parts in (1, 2, 3, 5, 7, 11):
            found.add(self.over_partitions(df, parts))
        exact = [round(value * 100) for (value,) in rows]
        numerator = 200 * sum(c * c for c in exact) - sum(exact) ** 2
        assert len(found) == 1 and found.pop()[0] == pytest.approx(numerator / 200**2 / 10**4, rel=1e-15)
