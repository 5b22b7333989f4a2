"""Nearest neighbours by largest cosine, as a block matrix join.

Vectors are scaled to length 1 and cut to int8. A grid of cells, each one block of
queries against one block of candidates, multiplies the int8 tiles. The product is
off the true cosine by at most |e_q| |c| + |q'| |e_c| (e: what the cut lost, q': the
cut query), so a candidate whose upper bound is below the k-th largest lower bound of
its query cannot be among the k nearest. What is left is recomputed in double precision
from the original vectors, kept in a heap of k per query and cell, and merged.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part; ids that are null neither. Only vectors of equal length are
compared. Ties go to the smaller id, so of equal vectors only the k + 1 smallest ids
are looked at. An id on several rows has the smallest of its vectors, and is never its
own neighbour. Queries without candidates have no rows. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .blocks import unpack
from .shipping import map_groups

QUERIES_PER_BLOCK = 4096
CANDIDATES_PER_BLOCK = 16384
TILE = 2048

_BLOCK = "dims int, cell_q int, cell_c int, is_query boolean, ids binary, vectors binary"
_FOUND = "query_id bigint, vec_id bigint, score double"


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    items = F.col(vector).cast("array<double>")
    fine = F.forall(items, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(items, lambda x: x != 0)
    return (
        vectors.select(F.col(key).alias("id"), items.alias("v"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine & some)
        .groupBy("id")
        .agg(F.min("v").alias("v"))
        .withColumn("dims", F.size("v"))
    )


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _cut(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, and the length of what the cut lost."""
    scale = np.abs(unit).max(axis=1) / 127.0
    cut = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = unit - cut * scale[:, None]
    return cut, scale, np.sqrt((lost * lost).sum(axis=1))


def _cosine(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Of original vectors, with sums that do not depend on how rows were batched."""
    q, c = query / np.abs(query).max(), candidates / np.abs(candidates).max(axis=1, keepdims=True)
    products = [math.fsum(row) for row in (c * q).tolist()]
    lengths = [math.sqrt(math.fsum(row)) for row in (c * c).tolist()]
    return np.array(products) / (np.array(lengths) * math.sqrt(math.fsum((q * q).tolist())))


def _first_of_equal(ids: np.ndarray, vectors: np.ndarray, count: int) -> np.ndarray:
    """Rows of the ``count`` smallest ids of each distinct vector. ids are sorted."""
    rows = np.ascontiguousarray(vectors + 0.0).view(f"V{vectors.shape[1] * 8}").ravel()
    _, group = np.unique(rows, return_inverse=True)
    order = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0])
    nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return np.sort(order[nth < count])


def nearest_in_cell(q_ids, q, c_ids, c, k: int) -> list[tuple[int, int, float]]:
    """The k nearest candidates of each query of one cell: (query, candidate, score)."""
    first = _first_of_equal(c_ids, c, k + 1)
    c_ids, c = c_ids[first], c[first]
    (q_cut, q_scale, q_lost), (c_cut, c_scale, c_lost) = _cut(_unit(q)), _cut(_unit(c))
    # Products of int8 vectors are whole numbers; float32 holds them up to 2^24.
    exact = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    c_tile = c_cut.astype(exact).T
    q_length = np.sqrt((q_cut.astype(np.float64) ** 2).sum(axis=1)) * q_scale
    found = []
    for at in range(0, len(q_ids), TILE):
        rows = slice(at, at + TILE)
        product = (q_cut[rows].astype(exact) @ c_tile).astype(np.float64)
        product *= q_scale[rows, None] * c_scale[None, :]
        slack = q_lost[rows, None] + q_length[rows, None] * c_lost[None, :] + 1e-9
        lower = product - slack
        lower[q_ids[rows, None] == c_ids[None, :]] = -np.inf
        if lower.shape[1] > k:
            least = np.partition(lower, lower.shape[1] - k, axis=1)[:, lower.shape[1] - k]
        else:
            least = np.full(len(lower), -np.inf)
        near_q, near_c = np.nonzero((product + slack >= least[:, None]) & (q_ids[rows, None] != c_ids[None, :]))
        for i in np.unique(near_q):
            chosen = near_c[near_q == i]
            scores = _cosine(q[at + i], c[chosen])
            best = heapq.nlargest(k, zip(scores.tolist(), (-c_ids[chosen]).tolist()))
            found += [(int(q_ids[at + i]), -other, score) for score, other in best]
    return found


def _packed(usable: DataFrame, block: Column, cell: str, other: str, others: int, is_query: bool) -> DataFrame:
    """Blocks of vectors as packed rows, one copy for each block they meet."""

    def run(key, table):
        order = np.argsort(table["id"].to_numpy(), kind="stable")
        ids = table["id"].to_numpy()[order]
        vectors = np.array(table["v"].to_pylist(), np.float64)[order]
        row = {"dims": key[0].as_py(), cell: key[1].as_py(), "ids": ids.tobytes(), "vectors": vectors.tobytes()}
        return pa.table({k: [v] for k, v in row.items()}, schema=schema)

    schema = pa.schema([("dims", pa.int32()), (cell, pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])
    blocks = usable.withColumn(cell, block.cast("int"))
    packed = map_groups(blocks, ["dims", cell], run, f"dims int, {cell} int, ids binary, vectors binary")
    every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
    return packed.select("*", every.alias(other)).select(
        "dims", "cell_q", "cell_c", F.lit(is_query).alias("is_query"), "ids", "vectors"
    )


def nearest(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest candidates of every query."""
    q, c = _usable(queries, key, vector), _usable(candidates, key, vector)
    sizes = q.agg(F.count(F.lit(1))).first()[0], c.agg(F.count(F.lit(1))).first()[0]
    q_blocks = max(1, math.ceil(sizes[0] / QUERIES_PER_BLOCK))
    c_blocks = max(1, math.ceil(sizes[1] / CANDIDATES_PER_BLOCK))
    c_blocks = max(c_blocks, 12 if sizes[1] > 12 * 256 else 1)
    q_block, c_block = F.pmod(F.xxhash64("id"), F.lit(q_blocks)), F.pmod(F.xxhash64("id"), F.lit(c_blocks))
    tiles = _packed(q, q_block, "cell_q", "cell_c", c_blocks, True).unionByName(
        _packed(c, c_block, "cell_c", "cell_q", q_blocks, False)
    )
    result = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(key, table):
        dims, sides = key[0].as_py(), []
        for side in (True, False):
            part = table.filter(pc.equal(table["is_query"], side))
            sides += [unpack(part["ids"], np.int64), unpack(part["vectors"], np.float64).reshape(-1, dims)]
        if not len(sides[0]) or not len(sides[2]):
            return result.empty_table()
        found = nearest_in_cell(*sides, k)
        return pa.table([list(x) for x in zip(*found)], schema=result) if found else result.empty_table()

    found = map_groups(tiles, ["dims", "cell_q", "cell_c"], run, _FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
