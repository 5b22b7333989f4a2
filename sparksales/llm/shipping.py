"""Makes this package importable where Python functions run."""

from __future__ import annotations

import ctypes
import inspect
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Application id to the folder of its archive, which lasts as long as this process.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}
_RELEASE_BYTES = 1 << 20
_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory()
    archive = os.path.join(folder.name, f"{os.path.basename(_PACKAGE)}-{context.applicationId}.zip")
    with zipfile.ZipFile(archive, "w") as sources:
        for at, _, names in os.walk(_PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    sources.write(path, os.path.relpath(path, os.path.dirname(_PACKAGE)))
    context.addPyFile(archive)


def release() -> None:
    """Give freed memory back to the system. Workers live on between tasks and stages and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run):
    """``run`` for ``mapInArrow``, with freed memory given back when a task's rows are done."""

    def over(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return over


def releasing_groups(run):
    """``run`` for ``applyInArrow``, with freed memory given back after large groups."""

    def over(*given):
        size = sum(x.nbytes for x in given if isinstance(x, pa.Table))
        found = run(*given)
        if size >= _RELEASE_BYTES:
            del given
            release()
        return found

    # Spark goes by the number of parameters.
    by_number = {1: lambda a: over(a), 2: lambda a, b: over(a, b), 3: lambda a, b, c: over(a, b, c)}
    return by_number[len(inspect.signature(run).parameters)]


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` of a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(releasing(run), schema)


def map_groups(df: DataFrame, keys: list[str], run, schema) -> DataFrame:
    """``applyInArrow`` of a function of this package to the groups of ``keys``."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(releasing_groups(run), schema)


def map_cogroups(left: DataFrame, right: DataFrame, keys: list[str], run, schema) -> DataFrame:
    ship(left.sparkSession)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(releasing_groups(run), schema)
