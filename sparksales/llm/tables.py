"""Small helpers for the tables that queries read and the schemas they return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_fields(schema: StructType, ddl: str) -> StructType:
    """A new schema with the fields of ``ddl`` behind those of ``schema``."""
    return StructType(schema.fields + StructType.fromDDL(ddl).fields)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as it takes not to clash with a column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
