from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

import sparksales as ss


def rows_of(seed, count):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        kind = i % 3  # a third of all rows in each of two groups
        group = "ties" if kind == 0 else "wide" if kind == 1 else f"g{rng.randrange(9)}"
        value = rng.choice([1.0, 1.0, 1.0, 2.0]) if group == "ties" else rng.lognormvariate(0, 6) * rng.choice([1, -1])
        rows.append((group, rng.randrange(2), value))
    return rows + [("extreme", 0, v) for v in (-1.7e308, 1.7e308, 5e-324, 0.0, -0.0, 1e-300)] + [("one", 0, 3.5)]


def expected(rows, levels):
    groups = defaultdict(list)
    for a, b, value in rows:
        groups[a, b].append(value)
    found = {}
    for key, values in groups.items():
        values.sort()
        for name, p in levels.items():
            at = (len(values) - 1) * p
            low, high = values[int(np.floor(at))], values[int(np.ceil(at))]
            found[*key, name] = low + (at - np.floor(at)) * (high - low)
    return found


@pytest.mark.parametrize("buckets, small", [(1024, 1000), (16, 3), (2, 1)])
def test_by_definition(spark, buckets, small):
    rows, levels = rows_of(buckets, 900), {"P0": 0.0, "P50": 0.5, "P80": 0.8, "P90": 0.9, "P100": 1.0}
    df = spark.createDataFrame(rows, "a string, b int, value double").repartition(5)
    if buckets == 2:  # many rounds
        rows = [row for row in rows if row[0] in ("ties", "g1")][:150]
        levels = {"P80": 0.8}
        df = spark.createDataFrame(rows, "a string, b int, value double")
    got = {(r.a, r.b, r.percentile_level): r.threshold for r in ss.exact_percentiles(df, ["a", "b"], "value", levels, buckets, small).collect()}
    want = expected(rows, levels)
    assert set(got) == set(want)
    for key, value in want.items():
        assert got[key] == pytest.approx(value, rel=1e-12), key


def test_what_does_not_count(spark):
    rows = [("a", 1.0), ("a", None), ("a", float("nan")), ("a", float("inf")), ("a", 3.0), (None, 5.0), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = ss.exact_percentiles(df, ["k"], "v", {"half": 0.5}).collect()
    assert [tuple(row) for row in got] == [("a", "half", 0.5, 2.0)]
    assert ss.exact_percentiles(df.limit(0), ["k"], "v").collect() == []
    with pytest.raises(ValueError):
        ss.exact_percentiles(df, ["k"], "v", buckets=1)


def test_no_group_is_sorted(spark):
    df = spark.createDataFrame(rows_of(1, 300), "a string, b int, value double")
    text = ss.exact_percentiles(df, ["a"], "value", small=50)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "ExistingRDD" not in text  # all rounds are staged
