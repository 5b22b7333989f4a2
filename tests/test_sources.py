from __future__ import annotations

import csv
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import sparksales as ss
from sparksales.schema import RAW_COLUMNS
from sparksales.sources.star_schema import ROW_KEY, sales_from_tables

HEADER = ",".join(RAW_COLUMNS)


def line(**values):
    """One CSV line; a value is written as given, quotes included."""
    return ",".join(values.get(name.replace(" ", "_").replace("-", "_"), "") for name in RAW_COLUMNS)


def read(spark, folder, text, name="part.csv"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return ss.read_sales_csv(spark, str(folder))


def test_quotes_commas_and_types(spark, tmp_path):
    text = "\n".join(
        [
            HEADER,
            line(index="1", Style='"x, ""y"" z"', Date="04-30-22", Qty="2", Amount="647.62", promotion_ids='"A, B,,A"'),
            line(index="2", Style='"q\\"', SKU="S\\2", Date="02-30-22", Qty="1.0", Amount="abc"),
        ]
    )
    rows = ss.typed_sales(read(spark, tmp_path / "in", text)).orderBy("row_id").collect()
    assert rows[0]["style"] == 'x, "y" z' and rows[0]["qty"] == 2 and rows[0]["amount"] == 647.62
    assert str(rows[0]["order_date"]) == "2022-04-30" and rows[0]["promotion_ids"] == "A, B,,A"
    assert (rows[1]["style"], rows[1]["sku"]) == ("q\\", "S\\2")
    assert rows[1]["order_date"] is None and rows[1]["qty"] is None and rows[1]["amount"] is None
    assert str(ss.typed_sales(ss.read_sales_csv(spark, str(tmp_path / "in")), clamp_days=True).filter("row_id = 2").first()["order_date"]) == "2022-02-28"


def test_headers_short_rows_and_blank_lines(spark, tmp_path):
    text = "\n".join([HEADER, line(index="1"), "", "4,short", HEADER, line(index="5", Size='""')])
    sales = ss.typed_sales(read(spark, tmp_path / "in", text))
    rows = {row["row_id"]: row for row in sales.collect()}
    assert set(rows) == {1, 4, 5}
    assert rows[4]["order_id"] == "short" and rows[4]["state"] is None
    assert ss.bought_orders(sales).count() == 0


def test_file_without_header_keeps_its_first_row(spark, tmp_path):
    read(spark, tmp_path / "in", HEADER + "\n" + line(index="1") + "\n", "a.csv")
    raw = read(spark, tmp_path / "in", line(index="2") + "\n", "b.csv")
    assert sorted(row["row_id"] for row in ss.typed_sales(raw).collect()) == [1, 2]


def test_rejected_cells_and_lines(spark, tmp_path):
    text = "\n".join(
        [
            HEADER,
            line(index="1", Order_ID="a", Date="02-30-22", Qty="x", Amount="1.5"),
            line(index="2", Order_ID="b", Date=" ", Qty="", Amount="12,5".join('""')),
            "4,short",
            HEADER,
            line(index="5", Order_ID="c", Date="02-28-22", Qty="1", Amount="1e3") + ",one,more",
        ]
    )
    read(spark, tmp_path / "in", text)
    raw = ss.read_sales_csv(spark, str(tmp_path / "in"), bad_line="broken")
    found = {tuple(row) for row in ss.rejected_cells(raw, bad_line="broken").collect()}
    cells = {("a", "order_date", "02-30-22"), ("a", "qty", "x"), ("b", "amount", "12,5")}
    assert {row for row in found if row[1] != "line"} == cells
    assert {(row[0], row[2].split(",")[0]) for row in found if row[1] == "line"} == {("short", "4"), ("c", "5")}
    assert {tuple(row) for row in ss.rejected_cells(ss.read_sales_csv(spark, str(tmp_path / "in"))).collect()} == cells
    report = {row["column"]: (row["filled"], row["rejected"]) for row in ss.parsing_report(raw, bad_line="broken").collect()}
    assert report == {"row_id": (4, 0), "order_date": (2, 1), "qty": (2, 1), "amount": (3, 1), "line": (4, 2)}
    clamped = ss.parsing_report(raw, clamp_days=True).filter("column = 'order_date'").first()
    assert (clamped["filled"], clamped["rejected"]) == (2, 0)
    assert sorted(row["row_id"] for row in ss.typed_sales(raw).collect()) == [1, 2, 4, 5]
    nothing = ss.parsing_report(raw.limit(0)).collect()
    assert {(row["filled"], row["rejected"]) for row in nothing} == {(0, 0)}


def results(spark):
    rows = [("TP, HCM", 'size "M"', 1, 0.5), ("  padded ", "S\tT", 2, None), ("plain", "", 3, 12345678.5)]
    return spark.createDataFrame(rows, "state string, size string, n bigint, variance double")


def test_csv_folder_round_trip(spark, tmp_path):
    target = str(tmp_path / "out")
    ss.write_result(results(spark), target)
    schema = "state string, size string, n bigint, variance double"
    back = spark.read.csv(target, schema=schema, header=True, quote='"', escape='"').collect()
    assert {row["state"] for row in back} == {"TP, HCM", "  padded ", "plain"}
    assert {row["n"]: row["variance"] for row in back} == {1: 0.5, 2: None, 3: 12345678.5}
    with pytest.raises(FileExistsError):
        ss.write_result(results(spark), target)


def test_single_csv_file(spark, tmp_path):
    target = tmp_path / "deep" / "out.csv"
    ss.write_result(results(spark).repartition(3), f"file://{target}", single_file=True, order_by=["n"])
    assert target.read_text().splitlines()[0] == "state,size,n,variance"
    with open(target, newline="") as handle:
        rows = list(csv.reader(handle))
    assert rows[1:] == [
        ["TP, HCM", 'size "M"', "1", "0.5"],
        ["  padded ", "S\tT", "2", ""],
        ["plain", "", "3", "1.23456785E7"],
    ]
    assert [name for name in os.listdir(target.parent) if not name.endswith(".crc")] == ["out.csv"]
    with pytest.raises(FileExistsError):
        ss.write_result(results(spark), str(target), single_file=True)


def test_single_parquet_file_is_sorted(spark, tmp_path):
    target = tmp_path / "out.parquet"
    numbers = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n")).repartition(6)
    ss.write_result(numbers, str(target), "parquet", single_file=True, order_by=["n"])
    assert target.is_file()
    assert pq.read_table(target)["n"].to_pylist() == list(range(5000))


def test_single_file_refuses_large_results(spark, tmp_path):
    target = tmp_path / "out.parquet"
    with pytest.raises(ValueError, match="more than the 10 asked for"):
        ss.write_result(spark.range(100), str(target), "parquet", single_file=True, single_file_bytes=10)
    assert not target.exists()


def test_single_file_has_no_limit_of_its_own(spark, tmp_path):
    target = tmp_path / "out.parquet"
    rows = spark.range(200_000).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 512), 16).alias("text"))
    ss.write_result(rows, str(target), "parquet", single_file=True, order_by=[F.desc("id")])
    assert target.is_file() and pq.read_table(target, columns=["id"])["id"].to_pylist() == list(range(199_999, -1, -1))


@pytest.mark.parametrize("text, expected", [("17", 17), ("17.0", 17), (" 1.9 ", 1), ("-3.0", -3), ("x", None), ("", None), ("1e3", 1000), ("9" * 25, None)])
def test_row_ids_of_float_columns(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(ss.parse_row_id(F.col("t"))).first()[0] == expected


def test_empty_single_file_has_a_header(spark, tmp_path):
    target = tmp_path / "out.csv"
    ss.write_result(results(spark).filter("n > 9"), str(target), single_file=True, order_by=["n"])
    assert target.read_text().strip() == "state,size,n,variance"


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown format"):
        ss.write_result(spark.range(1), str(tmp_path / "out"), "orc")


def test_tasks_of_the_star_schema_grow_in_number(spark, tmp_path):
    lines = 400_000
    noise = [F.rand(i).alias(name) for i, name in enumerate(("l_quantity", "l_extendedprice", "l_discount", "l_tax"))]
    tables = {
        "nation": spark.range(5).select(F.col("id").alias("n_nationkey"), F.format_string("N%d", "id").alias("n_name")),
        "customer": spark.range(100).select(
            F.col("id").alias("c_custkey"), (F.col("id") % 5).alias("c_nationkey"), F.lit("M").alias("c_mktsegment")
        ),
        "part": spark.range(50).select(
            F.col("id").alias("p_partkey"), F.lit("a b").alias("p_name"), F.lit("B").alias("p_brand"),
            F.lit("T").alias("p_type"), F.lit(3).alias("p_size"),
        ),
        "orders": spark.range(lines // 4).select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 100).alias("o_custkey"), F.lit("5-LOW").alias("o_orderpriority")
        ),
        "lineitem": spark.range(lines).select(
            (F.col("id") % (lines // 4)).alias("l_orderkey"), (F.col("id") % 50).alias("l_partkey"),
            F.col("id").alias("l_suppkey"), (F.col("id") % 4 + 1).cast("int").alias("l_linenumber"), *noise,
            F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
            F.timestamp_seconds(F.col("id") % 3 * 86400).alias("l_shipdate"),
        ),
    }
    for name, table in tables.items():
        table.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet", compression="none")
    sales = sales_from_tables(spark, str(tmp_path))
    counts = ss.valid_promotion_counts(sales, row_key=ROW_KEY)
    found = counts.withColumn("task", F.spark_partition_id()).groupBy("task").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("valid_promotion_count").alias("ids")
    ).collect()
    # Brand and both words; the first line of an order has no id, the next ones one, two and three.
    assert sum(row["rows"] for row in found) == lines and sum(row["ids"] for row in found) == lines // 4 * 6
    size = sum(file.stat().st_size for file in (tmp_path / "lineitem.parquet").glob("*.parquet"))
    assert max(row["rows"] for row in found) < 1.5 * lines * (2 << 20) / size
