"""Column names of the raw sales table and of the typed relation built from it."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw table's header, in file order. "Sales Channel " really
# ends with a space.
RAW_COLUMNS = (
    "index",
    "Order ID",
    "Date",
    "Status",
    "Fulfilment",
    "Sales Channel ",
    "ship-service-level",
    "Style",
    "SKU",
    "Category",
    "Size",
    "ASIN",
    "Courier Status",
    "Qty",
    "currency",
    "Amount",
    "ship-city",
    "ship-state",
    "ship-postal-code",
    "ship-country",
    "promotion-ids",
    "B2B",
    "fulfilled-by",
    "Unnamed: 22",
)

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in RAW_COLUMNS])

# Typed relation every operator starts from: name -> (raw column, kind).
SALES_COLUMNS = {
    "row_id": ("index", "row id"),
    "order_id": ("Order ID", "text"),
    "order_date": ("Date", "date"),
    "status": ("Status", "text"),
    "fulfilment": ("Fulfilment", "text"),
    "service_level": ("ship-service-level", "text"),
    "courier_status": ("Courier Status", "text"),
    "style": ("Style", "text"),
    "sku": ("SKU", "text"),
    "size": ("Size", "text"),
    "qty": ("Qty", "long"),
    "amount": ("Amount", "double"),
    "city": ("ship-city", "text"),
    "state": ("ship-state", "text"),
    "promotion_ids": ("promotion-ids", "text"),
}
