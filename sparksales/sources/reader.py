"""Raw CSV with an explicit schema, and the typed relation built from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import clean, is_filled, parse_date, parse_double, parse_long, parse_row_id
from ..schema import RAW_COLUMNS, RAW_SCHEMA, SALES_COLUMNS


def read_sales_csv(spark: SparkSession, path: str | list[str], bad_line: str | None = None) -> DataFrame:
    """All 24 columns as text; nothing is inferred.

    Header lines are dropped by content, wherever they stand, so files with and
    without a header, or several files joined into one, lose no data row. Short
    rows get nulls. A doubled quote inside a quoted field is one quote. Lines are
    records, so large files split.

    ``bad_line`` names a further column that holds the line itself where its number of
    fields is not 24. Such a read parses all columns.
    """
    schema, options = RAW_SCHEMA, {}
    if bad_line is not None:
        schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(bad_line, T.StringType(), True)])
        # Lines are counted as long as no column is left out.
        options = {"columnNameOfCorruptRecord": bad_line, "columnPruning": False}
    raw = spark.read.options(**options).csv(
        path, schema=schema, header=False, quote='"', escape='"', multiLine=False, mode="PERMISSIVE"
    )
    first = F.col(f"`{RAW_COLUMNS[0]}`")
    return raw.filter(first.isNull() | (clean(first) != RAW_COLUMNS[0]))


def _parsers(clamp_days: bool) -> dict:
    return {
        "text": clean,
        "long": parse_long,
        "row id": parse_row_id,
        "double": parse_double,
        "date": lambda text: parse_date(text, clamp=clamp_days),
    }


def typed_sales(raw: DataFrame, clamp_days: bool = False) -> DataFrame:
    """Typed sales relation from the raw text columns; a bad value becomes null.

    ``clamp_days`` moves days a month does not have back to its last day instead of
    giving a null date. Operators select what they need, so unused columns are
    neither read nor parsed. ``rejected_cells`` tells which values became null.
    """
    parsers = _parsers(clamp_days)
    return raw.select(*[parsers[kind](F.col(f"`{column}`")).alias(name) for name, (column, kind) in SALES_COLUMNS.items()])


def _cells(clamp_days: bool) -> list[tuple[str, Column, Column]]:
    """(name, text, rejected) of every column that is parsed; a blank cell is empty, not rejected."""
    parsers, found = _parsers(clamp_days), []
    for name, (column, kind) in SALES_COLUMNS.items():
        if kind != "text":
            text = F.col(f"`{column}`")
            found.append((name, text, is_filled(clean(text)) & parsers[kind](text).isNull()))
    return found


def rejected_cells(raw: DataFrame, clamp_days: bool = False, bad_line: str | None = None) -> DataFrame:
    """(order_id, column, text) of every cell that ``typed_sales`` reads as null although it is filled.

    With the ``bad_line`` column of ``read_sales_csv``, also one row for each line with a wrong
    number of fields: its column is ``line`` and its text the line. Meant for a
    quarantine output that can be mended and read again.
    """
    marked = [
        F.when(rejected, F.struct(F.lit(name).alias("column"), text.alias("text"))) for name, text, rejected in _cells(clamp_days)
    ]
    if bad_line is not None:
        line = F.col(bad_line)
        marked.append(F.when(line.isNotNull(), F.struct(F.lit("line").alias("column"), line.alias("text"))))
    found = raw.select(clean(F.col("`Order ID`")).alias("order_id"), F.explode(F.array_compact(F.array(*marked))).alias("cell"))
    return found.select("order_id", "cell.column", "cell.text")


def parsing_report(raw: DataFrame, clamp_days: bool = False, bad_line: str | None = None) -> DataFrame:
    """(column, filled, rejected): cells of every parsed column, in one scan and one small aggregate."""
    counted = [(name, is_filled(clean(text)), rejected) for name, text, rejected in _cells(clamp_days)]
    if bad_line is not None:
        counted.append(("line", F.lit(True), F.col(bad_line).isNotNull()))
    totals = raw.agg(
        *[F.count_if(filled).alias(f"{name}_filled") for name, filled, _ in counted],
        *[F.count_if(rejected).alias(f"{name}_rejected") for name, _, rejected in counted],
    )
    rows = [
        F.struct(F.lit(name).alias("column"), F.col(f"{name}_filled").alias("filled"), F.col(f"{name}_rejected").alias("rejected"))
        for name, _, _ in counted
    ]
    return totals.select(F.explode(F.array(*rows)).alias("row")).select("row.*")
