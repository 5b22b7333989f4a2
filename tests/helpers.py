from __future__ import annotations

from datetime import date

SCHEMA = """row_id bigint, order_id string, order_date date, status string, fulfilment string, service_level string,
courier_status string, style string, sku string, size string, qty bigint, amount double, city string, state string,
promotion_ids string"""
NAMES = [part.split()[0] for part in SCHEMA.replace("\n", " ").split(",")]

DEFAULTS = dict(
    order_id="o",
    order_date=date(2022, 4, 30),
    status="Shipped",
    fulfilment="Merchant",
    service_level="Standard",
    courier_status="Shipped",
    style="ST",
    sku="SK",
    size="M",
    qty=1,
    amount=100.0,
    city="HUE",
    state="TT",
    promotion_ids=None,
)


def sales_frame(spark, rows):
    """Sales relation from partial rows; row_id defaults to the position."""
    complete = [{"row_id": number, **DEFAULTS, **row} for number, row in enumerate(rows)]
    return spark.createDataFrame([tuple(row[name] for name in NAMES) for row in complete], SCHEMA)


def day(text: str) -> date:
    return date.fromisoformat(text)


def dicts(df):
    return [row.asDict() for row in df.collect()]
