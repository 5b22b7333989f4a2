"""The physical plans keep the shapes that matter at scale."""

from __future__ import annotations

import functools
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import sparksales as ss
from sparksales.operators.staging import session_folder
from sparksales.plans import city_percentage
from sparksales.sources.star_schema import ROW_KEY, sales_from_tables

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark):
    return ss.stage(sales_from_tables(spark, FOLDER, sku="p_brand"))


# Queries of the optional training-data package may use Python where their method needs it.
OPTIONAL = set(contract.training_data.queries()) | {"pipeline"} if contract.training_data else set()


@pytest.mark.parametrize("name", [name for name in contract.queries() if name not in OPTIONAL])
def test_no_python_and_no_pairing_of_everything(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "SinglePartition, REPARTITION"):
        assert unwanted not in text


def test_deviation_reads_and_shuffles_rows_once(landed):
    text = plan(ss.threshold_stddev(landed, row_key=ROW_KEY))
    assert text.count("FileScan") == 1
    assert "Join" not in text
    # Rows are combined before the only exchange that sees them.
    assert re.findall(r"Exchange (\w+)\(", text) == ["rangepartitioning", "hashpartitioning", "hashpartitioning"]
    assert text.rindex("Exchange hashpartitioning") < text.rindex("partial_count(1)") < text.index("FileScan")


def test_columns_are_pruned(landed):
    text = plan(ss.median_variety(landed))
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert {part.split(":")[0] for part in schema.split(",")} == {"order_date", "style", "sku", "size", "state"}
    assert "IsNotNull(order_date)" in text


def test_text_columns_are_pruned(spark, tmp_path):
    (tmp_path / "part.csv").write_text("")
    text = plan(ss.bought_by_state(ss.typed_sales(ss.read_sales_csv(spark, str(tmp_path)))))
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert {part.split(":")[0] for part in schema.split(",")} == {"index", "Date", "Status", "Size", "Qty", "ship-state"}


def test_winner_is_cut_to_one_row_before_the_shuffle(landed):
    text = plan(ss.winning_category(landed, threshold=50))
    partial, final = text.index("row_number(), 1, Partial"), text.index("row_number(), 1, Final")
    assert final < text.index("Exchange hashpartitioning(state", final) < partial
    # The day copies are aggregated where they are made.
    between = text[partial : text.index("Generate explode")]
    assert "Exchange" not in between
    assert "BroadcastHashJoin" in text


def test_sums_of_amounts_are_hash_aggregated(landed):
    for df in (ss.winning_category(landed, threshold=50), ss.window_bucket_summary(landed, threshold=50), ss.threshold_stddev(landed, row_key=ROW_KEY)):
        text = plan(df)
        for unwanted in ("ObjectHashAggregate", "SortAggregate", "collect_list", "lambda"):
            assert unwanted not in text
        # Two pieces for each weight of the squares, and all of them whole numbers.
        assert "sum(amount_low_6" in text and "sum(amount_high_6" in text


def test_filters_on_variances_stay_short(landed):
    buckets = ss.window_bucket_summary(landed, threshold=50)
    assert len(plan(buckets.filter("population_variance > 5 OR population_variance < 3"))) < 2 * len(plan(buckets))


def test_city_report_never_shuffles_candidate_rows(landed):
    text = plan(ss.city_qualifying_pct(landed, row_key=ROW_KEY))
    # The lists were staged; their counts come back by a short key.
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_lists_are_not_shuffled_once_per_id(spark, landed, monkeypatch):
    monkeypatch.setattr(city_percentage, "lookup_join", functools.partial(ss.lookup_join, broadcast_bytes=0))
    valid = ss.stage_lookup(ss.valid_promotions(landed, row_key=ROW_KEY))
    lists = landed.select("promotion_ids", F.xxhash64("promotion_ids").alias("list_key"))
    below = city_percentage._valid_by_list(lists, valid)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in below
    for line in below.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "promotion_ids" not in line
    counts = city_percentage._valid_by_list(lists, valid).count()
    monkeypatch.undo()
    assert city_percentage._valid_by_list(lists, valid).count() == counts > 0


def test_large_lookups_are_not_broadcast(spark, landed):
    lookup = ss.stage_lookup(ss.bought_by_state(landed))
    daily = ss.stage(ss.daily_summary(landed))
    salted = ss.lookup_join(daily, lookup, "state", ["order_date"], broadcast_bytes=0)
    plain = ss.lookup_join(daily, lookup, "state", ["order_date"], broadcast_bytes=0, repeated_bytes=0)
    small = ss.lookup_join(daily, lookup, "state", ["order_date"])
    assert "Broadcast" not in plan(salted) and "salt" in plan(salted)
    assert "Broadcast" not in plan(plain) and "salt" not in plan(plain)
    assert "BroadcastHashJoin" in plan(small)
    rows = sorted(small.collect())
    assert sorted(salted.select(small.columns).collect()) == rows == sorted(plain.select(small.columns).collect())


def test_staged_relations_go_to_the_shared_folder(spark, landed):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared is None or session_folder(spark).startswith(shared)
    assert all(session_folder(spark) in file for file in landed.inputFiles())
    assert ss.staged_bytes(landed) > 0


def test_no_local_folder_on_a_cluster():
    class Context:
        master, applicationId = "yarn", "application_1"

        def getCheckpointDir(self):
            return None

    class Conf:
        settings = {}

        def get(self, key, default):
            return self.settings.get(key, default)

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session_folder(Session())
    Conf.settings = {"spark.checkpoint.dir": "hdfs://shared/folder/"}
    assert session_folder(Session()) == "hdfs://shared/folder/sparksales/application_1"


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "state",
        "window_date",
        "winning_size",
        "purchase_count",
        "population_variance",
        "window_length",
    ]
