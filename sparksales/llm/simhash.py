"""SimHash near-duplicates, found exactly with vantage-point trees.

Fingerprints: texts are lower-cased (A-Z), cut into words and word shingles, repeats
included; each shingle's XXH64 votes for the bits it has set, and a bit is set if more
than half of the shingles set it.

Links are pairs of fingerprints at most ``distance`` bits apart. A vantage-point tree
grown from a bounded sample splits the fingerprints by their Hamming distance to one
point per node: near ones left, far ones right. Each fingerprint has one home leaf
(shard). It also visits every other shard whose side of a boundary it could have a
partner on: by the triangle inequality that is a side whose bound is at most
``distance`` away. Inside a shard the tree goes on down to small leaves, where the rest
is compared. What a shard reports are not its pairs but a forest that joins the linked
fingerprints, so a group of m near copies sends fewer than m rows.

In 64 bits, distances of unrelated fingerprints lie close together, so a boundary
keeps about two thirds of the queries on both sides: work grows as about n^1.75.
Equal fingerprints are one point, whatever their number.

Defined results: null and empty texts, and texts without words, have fingerprint zero
and are linked like any other. Repeated rows have equal fingerprints. Null ids do not
count as the smallest of a component; a component without any id has a null
component_id. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import lookup_join
from ..operators.staging import stage, stage_lookup
from .components import connected_components
from .shipping import map_batches, map_groups
from .tables import free_name, with_fields

SEED = 42
SHARD_POINTS = 16384
LEAF_POINTS = 192
SAMPLE_POINTS = 8192
SLICE_BYTES = 1 << 20
CHUNK = 1 << 14


def shingle_hashes(text: bytes, words_each: int) -> list[int]:
    """XXH64 of the space-joined shingles; one of the whole sequence if there are fewer words."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= words_each:
        return [xxhash.xxh64_intdigest(joined, SEED)] if words else []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    name = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - words_each + 1].tolist(), ends[words_each - 1 :].tolist())
    return [name(joined[start:end], SEED) for start, end in spans]


def fingerprints_of(texts: list[bytes], words_each: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each text."""
    hashes = [shingle_hashes(text, words_each) for text in texts]
    counts = np.array([len(h) for h in hashes], np.int64)
    result = np.zeros(len(texts), np.uint64)
    full = counts > 0
    if full.any():
        every = np.array([h for own in hashes for h in own], np.uint64)
        bits = np.unpackbits(every.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(counts) - counts)[full]
        votes = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        majority = votes * 2 > counts[full, None]
        result[full] = np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()
    return result


def fingerprints(docs: DataFrame, words_each: int = 4, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``fingerprint_bits`` (the 64 bits as a bigint)."""
    given = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = with_fields(docs.select(*keep).schema, "fingerprint_bits bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.large_binary()).to_pylist()
            found, at = [np.zeros(0, np.uint64)], 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_BYTES):
                    size += len(texts[end])
                    end += 1
                found.append(fingerprints_of(texts[at:end], words_each))
                at = end
            bits = pa.array(np.concatenate(found).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], bits], schema.names)

    return map_batches(given, run, schema)


def _apart(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


class Router:
    """The upper part of the vantage-point tree; its leaves are shards."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.nodes: dict[int, tuple[np.uint64, int]] = {}
        self._grow(1, sample, depth)

    def _grow(self, node: int, sample: np.ndarray, depth: int) -> None:
        if depth == 0 or len(sample) < 4:
            return
        vantage = sample[0]
        apart = _apart(sample, vantage)
        bound = int(np.median(apart))
        near = apart <= bound
        if near.all():
            return
        self.nodes[node] = (vantage, bound)
        self._grow(2 * node, sample[near][1:], depth - 1)
        self._grow(2 * node + 1, sample[~near], depth - 1)

    def route(self, points: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shard, index of the point, whether it is the point's home)."""
        found = []
        todo = [(1, np.arange(len(points)), np.ones(len(points), bool))]
        while todo:
            node, at, home = todo.pop()
            if not len(at):
                continue
            if node not in self.nodes:
                found.append((np.full(len(at), node, np.int64), at, home))
                continue
            vantage, bound = self.nodes[node]
            apart = _apart(points[at], vantage)
            left, right = apart - distance <= bound, apart + distance > bound
            todo.append((2 * node, at[left], (home & (apart <= bound))[left]))
            todo.append((2 * node + 1, at[right], (home & (apart > bound))[right]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        return tuple(np.concatenate(part) for part in zip(*found))


class _Forest:
    """Joins points that are linked; roots are the smallest indices."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self, at: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[at]
            if (up == at).all():
                return at
            at = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            low, high = np.minimum(a, b), np.maximum(a, b)
            open_ = low != high
            a, b = low[open_], high[open_]
            np.minimum.at(self.parent, b, a)


def linked_in_shard(points: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(point, root) for every point joined to an earlier one, over all links to home points."""
    forest = _Forest(len(points))
    todo = [(np.flatnonzero(home), np.arange(len(points)))]
    while todo:
        own, visitors = todo.pop()
        if not len(own) or not len(visitors):
            continue
        if len(own) > LEAF_POINTS:
            vantage = points[own[0]]
            apart = _apart(points[own], vantage)
            bound = int(np.median(apart))
            near = apart <= bound
            if not near.all():
                theirs = _apart(points[visitors], vantage)
                todo.append((own[near], visitors[theirs - distance <= bound]))
                todo.append((own[~near], visitors[theirs + distance > bound]))
                continue
        for at in range(0, len(visitors), CHUNK):
            some = visitors[at : at + CHUNK]
            for first in range(0, len(own), LEAF_POINTS):
                part = own[first : first + LEAF_POINTS]
                close = np.bitwise_count(points[some][:, None] ^ points[part][None, :]) <= distance
                close &= some[:, None] != part[None, :]
                i, j = np.nonzero(close)
                forest.join(some[i], part[j])
    roots = forest.roots(np.arange(len(points)))
    joined = np.flatnonzero(roots != np.arange(len(points)))
    return points[joined], points[roots[joined]]


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b) of a forest that joins the ``fingerprint_bits`` of ``distinct`` at most ``distance`` apart."""
    spark = distinct.sparkSession
    points = distinct.select("fingerprint_bits")
    count = points.count()
    order = F.xxhash64("fingerprint_bits", F.lit(3))
    sample = points.orderBy(order, "fingerprint_bits").limit(SAMPLE_POINTS).collect()  # SAMPLE_POINTS rows at most
    sample = np.array([row[0] for row in sample], np.int64).view(np.uint64)
    depth = max(4 if count > 4096 else 0, math.ceil(math.log2(max(count, 1) / SHARD_POINTS)))
    shared = spark.sparkContext.broadcast(Router(sample, depth))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            shard, at, home = shared.value.route(own.view(np.uint64), distance)
            yield pa.RecordBatch.from_pydict({"shard": shard, "point": own[at], "home": home})

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(table):
        points, home = table["point"].to_numpy(), table["home"].to_numpy(zero_copy_only=False)
        order = np.argsort(points)
        a, b = linked_in_shard(points[order].view(np.uint64), home[order], distance)
        return pa.table([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    routed = map_batches(points, route, "shard bigint, point bigint, home boolean")
    return map_groups(routed, ["shard"], search, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    words_each: int = 4,
    distance: int = 4,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """(doc_id, row_hash, fingerprint_bits, label, component_id) of every row.

    ``label`` is equal within a component, ``component_id`` its smallest id, and
    ``row_hash`` a hash of id and text that tells rows of one id apart.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(key, text).alias("row_hash"), F.col(text).alias("text"))
    marked = stage(fingerprints(rows, words_each, "text", ("doc_id", "row_hash")))
    distinct = stage(marked.groupBy("fingerprint_bits").agg(F.min("doc_id").alias("first_id")))
    found = connected_components(links(distinct, distance))
    found = found.select(F.col("node").alias("fingerprint_bits"), "label")
    joined = distinct.join(found, "fingerprint_bits", "left")
    joined = joined.withColumn("label", F.coalesce("label", "fingerprint_bits"))
    smallest = joined.groupBy("label").agg(F.min("first_id").alias("component_id"))
    components = stage(joined.join(smallest, "label").select("fingerprint_bits", "label", "component_id"))
    return marked.join(components, "fingerprint_bits")


def one_of_each(docs: DataFrame, words_each: int = 4, distance: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with one row of each component: the smallest id's.

    Of several rows of that id the one with the smallest hash stays, of fully repeated rows one.
    """
    found = near_duplicates(docs, words_each, distance, text, key)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_hash")
    kept = found.groupBy("label").agg(F.min(order).alias("kept")).select("kept.row_hash")
    counted = found.groupBy("row_hash").agg(F.count(F.lit(1)).alias("copies"))
    kept = stage(kept.join(counted, "row_hash"))
    name = free_name(docs, "row_hash")
    hashed = docs.withColumn(name, F.xxhash64(key, text))
    single = stage_lookup(kept.where("copies = 1").select(F.col("row_hash").alias(name)))
    repeated = stage_lookup(kept.where("copies > 1").select(F.col("row_hash").alias(name)))
    # Texts stay where they are as long as the hashes are few enough to be broadcast.
    return (
        lookup_join(hashed, single, name, [name], "left_semi")
        .unionByName(lookup_join(hashed, repeated, name, [name], "left_semi").dropDuplicates([name]))
        .drop(name)
    )
