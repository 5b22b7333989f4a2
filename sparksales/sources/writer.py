"""Result sinks: CSV or Parquet, a folder of parts or one file. Never overwrites."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.staging import hadoop_path, stage, staged_bytes

_CSV = dict(
    header=True,
    quote='"',
    escape='"',
    nullValue="",
    emptyValue="",
    ignoreLeadingWhiteSpace=False,
    ignoreTrailingWhiteSpace=False,
)


def _write(df: DataFrame, folder: str, fmt: str) -> None:
    writer = df.write.mode("errorifexists")
    if fmt == "csv":
        writer.csv(folder, **_CSV)
    elif fmt == "parquet":
        writer.parquet(folder)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_result(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    single_file: bool = False,
    order_by: Sequence[str] = (),
    single_file_bytes: int | None = None,
) -> None:
    """Write a result; fails if ``path`` exists.

    By default ``path`` is a folder of parts written in parallel, in the order of
    ``df``. With ``single_file`` the result becomes one file at exactly ``path``,
    sorted by ``order_by`` and moved into place when complete. The result is computed
    in parallel first; one task then sorts and writes it. ``single_file_bytes`` refuses
    a result whose staged files are larger.
    """
    spark = df.sparkSession
    fs, target = hadoop_path(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    if not single_file:
        _write(df, path, fmt)
        return

    staged = stage(df)
    if single_file_bytes is not None and staged_bytes(staged) > single_file_bytes:
        raise ValueError(f"result has {staged_bytes(staged)} bytes, more than the {single_file_bytes} asked for")
    ordered = staged.coalesce(1)
    if order_by:
        ordered = ordered.sortWithinPartitions(*order_by)
    target = fs.makeQualified(target)
    _, scratch = hadoop_path(spark, f"{target.getParent().toString()}/.{target.getName()}-{uuid.uuid4().hex}")
    try:
        _write(ordered, scratch.toString(), fmt)
        parts = [status.getPath() for status in fs.listStatus(scratch) if status.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file, found {len(parts)}")
        if not fs.rename(parts[0], target):
            raise FileExistsError(path)
    finally:
        fs.delete(scratch, True)
