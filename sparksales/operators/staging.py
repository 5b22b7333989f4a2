"""Write an intermediate relation to the cluster's shared folder and read it back.

Used where several branches need the same aggregate: the big scan then runs once,
the lineage ends at files that outlive any executor, and Catalyst knows the
relation's real size when it plans the next join.
"""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_scopes: list[str] = []
_to_delete: set[str] = set()


def _shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, one in the warehouse."""
    context = spark.sparkContext
    local = context.master.startswith("local")
    configured = spark.conf.get(_CONF, None) or context.getCheckpointDir()
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not configured and not warehouse:
        raise ValueError(f"set {_CONF} to a folder that all executors share")
    folder = configured or f"{warehouse.rstrip('/')}/_staged"
    if folder.startswith("file:") and not local:
        raise ValueError(f"{folder} may be a folder of one machine: set {_CONF} to a folder that all executors share")
    if not configured and local and folder.startswith("file:") and folder not in _to_delete:
        # Nobody else knows of this folder, so it goes with the process.
        _to_delete.add(folder)
        atexit.register(shutil.rmtree, folder.removeprefix("file:"), ignore_errors=True)
    return folder


def session_folder(spark: SparkSession) -> str:
    return f"{_shared_folder(spark).rstrip('/')}/sparksales/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession) -> str:
    return "/".join([session_folder(spark), *_scopes, uuid.uuid4().hex])


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) of a path, whichever file system it lives on."""
    try:
        jvm, context = spark._jvm, spark._jsc
    except AttributeError as missing:
        raise RuntimeError("staging and single files need a classic Spark session, not Spark Connect") from missing
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context.hadoopConfiguration()), target


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end; what was staged before stays."""
    _scopes.append(uuid.uuid4().hex)
    fs, folder = hadoop_path(spark, "/".join([session_folder(spark), *_scopes]))
    try:
        yield
    finally:
        _scopes.pop()
        fs.delete(folder, True)


def stage(df: DataFrame, compression: str = "snappy") -> DataFrame:
    spark = df.sparkSession
    folder = new_folder(spark)
    df.write.parquet(folder, compression=compression)
    return spark.read.schema(df.schema).parquet(folder)


def stage_lookup(df: DataFrame) -> DataFrame:
    """Stage a relation with one row per key, uncompressed: its files are at least as large as its keys."""
    return stage(df, compression="none")


def staged_bytes(df: DataFrame) -> int:
    """Size of a relation as Catalyst knows it: file bytes for a staged one."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def release_staged(spark: SparkSession) -> None:
    """Delete everything this application staged. Results still read from it are gone too."""
    fs, path = hadoop_path(spark, session_folder(spark))
    fs.delete(path, True)
