"""Blocks of texts, and columns of numbers packed into binary cells.

Text operators deal documents to blocks by a hash and work on a whole block at once
with numpy. What blocks tell each other (names of phrases, counts, spans) travels as
packed rows: one row per (sender, receiver) pair holding equally long arrays as
bytes. Spark shuffles and sorts a few rows per task instead of one per word.

Every function here is a function of its input rows only, so a task that runs again
after a lost executor sends the same bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 24 << 20
PAIR_BYTES = 4 << 10
LEAST_PAIRS = 1 << 10
NULL_KEY = -(1 << 63)


def block_counts(df: DataFrame, size: Column) -> tuple[int, int]:
    """Numbers of blocks of texts and of buckets of names; see ``dealt_into``."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = df.agg(F.sum(size.cast("double"))).first()[0] or 0.0
    return dealt_into(total, partitions)


def dealt_into(total: float, partitions: int) -> tuple[int, int]:
    """Numbers of blocks and buckets for ``total`` bytes of texts.

    Neither holds more than fits a task. Blocks outnumber shuffle partitions, which evens
    them out; buckets do not, because each block sends a row to each bucket. What partitions
    ask for beyond the sizes is cut until such a pair has ``PAIR_BYTES`` of texts behind it,
    so that rows go by the texts and not by the square of the partitions.
    """
    least = math.ceil(total / BLOCK_BYTES), math.ceil(total / BUCKET_BYTES)
    blocks, buckets = max(4 * partitions, least[0]), max(partitions, least[1])
    fewer = math.sqrt(max(1.0, blocks * buckets / max(LEAST_PAIRS, total / PAIR_BYTES)))
    return max(1, int(blocks / fewer), least[0]), max(1, int(buckets / fewer), least[1])


def text_blocks(docs: DataFrame, text: str, key: str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(block, doc_key, row_hash, no_key, text, no_text, keep_...) of every row, and the number of buckets.

    A null key becomes the smallest bigint, a null text an empty one. Rows that are
    equal in key and text have equal ``row_hash`` and meet in one block.
    """
    count, buckets = block_counts(docs, F.octet_length(F.col(text)))
    body = F.coalesce(F.col(text), F.lit(""))
    doc_key = F.coalesce(F.col(key), F.lit(NULL_KEY))
    row_hash = F.xxhash64(doc_key, body)
    return docs.select(
        F.pmod(row_hash, F.lit(count)).cast("int").alias("block"),
        doc_key.alias("doc_key"),
        row_hash.alias("row_hash"),
        F.col(key).isNull().alias("no_key"),
        body.alias("text"),
        F.col(text).isNull().alias("no_text"),
        *[F.col(name).alias(f"keep_{name}") for name in keep if name not in (key, text)],
    ), buckets


def numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def in_order(table: pa.Table) -> pa.Table:
    """The rows of a block in an order that does not depend on how they arrived."""
    return table.take(np.lexsort((numbers(table["row_hash"]), numbers(table["doc_key"]))))


def keys_and_kept(table: pa.Table, names: list[str], text: str) -> list[pa.Array]:
    """The ids of a block's rows and the columns ``names``, with the nulls they came with."""
    keys = pa.array(numbers(table["doc_key"]), mask=numbers(table["no_key"]))

    def column(name: str) -> pa.Array:
        if name != text:
            return table[f"keep_{name}"].combine_chunks()
        return pc.if_else(table["no_text"], pa.scalar(None, pa.string()), table["text"].cast(pa.string())).combine_chunks()

    return [keys, *[column(name) for name in names]]


def joined_bytes(column: pa.ChunkedArray) -> tuple[bytes, np.ndarray]:
    """All texts, a line feed after each, and where each starts (one more than texts)."""
    texts = [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return b"\n".join([*texts, b""]), starts


def _cells(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    offsets = (bounds * values.dtype.itemsize).astype(np.int64)
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), data]).cast(pa.binary())


def pack(schema: pa.Schema, to: np.ndarray, constants: dict[str, int], columns: dict[str, np.ndarray]) -> pa.Table:
    """One row for each value of ``to``, with the entries that go there as packed cells."""
    if not len(to):
        return schema.empty_table()
    order = np.argsort(to, kind="stable")
    sorted_to = to[order]
    first = np.flatnonzero(np.r_[True, sorted_to[1:] != sorted_to[:-1]])
    bounds = np.r_[first, len(to)]
    rows = {schema.names[0]: pa.array(sorted_to[first].astype(np.int32))}
    rows |= {name: pa.array(np.full(len(first), value, np.int32)) for name, value in constants.items()}
    # Columns without entries stay empty.
    rows |= {name: _cells(values[order], bounds) for name, values in columns.items() if len(values)}
    empty = pa.array([b""] * len(first), pa.binary())
    return pa.table({name: rows.get(name, empty) for name in schema.names}, schema=schema)


def unpack(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """All entries of a packed column, row after row."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def entries_per_row(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.array([len(x) for x in column.to_pylist()], np.int64) // np.dtype(dtype).itemsize


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a 64-bit name, by its upper bits."""
    return ((names >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of range(start, start + length)."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.r_[0, np.cumsum(lengths)[:-1]], lengths)
    return np.arange(total, dtype=np.int64) + shift


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Boolean mask of the positions inside any [start, end)."""
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.subtract.at(steps, ends, 1)
    return np.cumsum(steps[:size], dtype=np.int32) > 0
