"""The sales relation as a view over an order/line-item star schema.

Stands in for a sales export where only such tables are at hand. Nulls, zero
quantities and promotion lists are derived from the tables' own columns by fixed
rules, so the view grows with the tables.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.staging import staged_bytes
from ..schema import RAW_COLUMNS, SALES_COLUMNS

# (l_orderkey, l_linenumber) alone repeats in these tables.
ROW_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "order_date")

# What a task of a join or of a grouping by ``ROW_KEY`` gets of the line items' files.
TASK_BYTES = 2 << 20

# Size names by p_size modulo 11.
_SIZES = ("Free", "XS", "S", "M", "L", "XL", "XXL", "3XL", "4XL", "5XL", "6XL")


def _promotions() -> Column:
    """The first ``l_linenumber - 1`` of six ids; ``DAY-`` ids live for one day only."""
    words = F.split("p_name", " ")
    ids = F.array(
        F.col("p_brand"),
        F.get(words, F.lit(0)),
        F.get(words, F.lit(1)),
        F.concat(F.lit("DAY-"), F.date_format("l_shipdate", "yyyy-MM-dd")),
        F.col("p_type"),
        F.col("c_mktsegment"),
    )
    return F.concat_ws(", ", F.slice(ids, F.lit(1), F.col("l_linenumber") - 1))


def _dealt(df: DataFrame, key: str, lines: DataFrame) -> DataFrame:
    """``df`` by ``key`` over as many tasks as ``lines`` need; as it is where the session makes that many.

    The other side of a join on ``key`` follows, and so does what is grouped by more than ``key``:
    tasks grow in number, not in size. Adaptive execution would go by compressed bytes and merge them.
    """
    spark = df.sparkSession
    tasks = math.ceil(staged_bytes(lines) / TASK_BYTES)
    made = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df if tasks <= made else df.repartition(tasks, key)


def sales_from_tables(spark: SparkSession, folder: str, sku: str = "p_partkey") -> DataFrame:
    """Typed sales relation, keyed by ``ROW_KEY``; ``sku`` names the part column used as SKU."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")

    # The order side is put together first, so the far larger lineitem moves only
    # for its own keys. Both sides grow alike, hence a merge join at every scale.
    buyers = table("customer").join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    placed = table("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    items = table("lineitem")
    lines = (
        items.join(_dealt(placed, "o_orderkey", items).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_dealt(table("part"), "p_partkey", items), F.col("l_partkey") == F.col("p_partkey"))
    )
    flag = F.col("l_returnflag")
    sizes = F.array(*[F.lit(size) for size in _SIZES])
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("order_date"),
        F.when(flag == "N", "Shipped - Delivered").when(flag == "A", "SHIPPED").when(flag == "R", "Cancelled").alias("status"),
        F.when(F.col("l_linestatus") == "F", "Merchant").otherwise("Amazon").alias("fulfilment"),
        F.when(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"), "Standard").otherwise("Expedited").alias("service_level"),
        F.when(flag == "R", "On the Way").otherwise("Shipped").alias("courier_status"),
        F.col("p_brand").alias("style"),
        F.col(sku).cast("string").alias("sku"),
        F.get(sizes, F.col("p_size") % len(_SIZES)).alias("size"),
        F.when(F.col("l_quantity") == 1, 0).otherwise(F.col("l_quantity")).cast("bigint").alias("qty"),
        F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).alias("amount"),
        F.concat(F.col("n_name"), F.lit("-"), (F.col("c_custkey") % 10).cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        _promotions().alias("promotion_ids"),
    )


def raw_from_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows as 24 text columns, as an export would hold them."""
    sales = sales_from_tables(spark, folder)
    values = {
        # Written with a fraction, as float columns are exported.
        "index": F.concat((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string"), F.lit(".0")),
        "Order ID": F.concat_ws("/", *[F.col(name).cast("string") for name in ROW_KEY]),
        "Date": F.date_format("order_date", "MM-dd-yy"),
    }
    for name, (column, kind) in SALES_COLUMNS.items():
        if column not in values:
            values[column] = F.col(name).cast("string")
    return sales.select(*[values.get(column, F.lit(None).cast("string")).alias(column) for column in RAW_COLUMNS])
