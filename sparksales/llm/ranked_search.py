"""Ranked lexical search over geometric blocks of posting lists.

Documents stay where they are: every task turns the documents it reads into shards, each a
small inverted and forward index of the terms that queries ask for. Global counts (documents,
terms, documents per term) are added up over all shards. Then every shard is searched for all
queries, a task taking what its earlier shards found as the score to beat, and the best of all
tasks are merged. No text and no posting list is shuffled, so a term that a third of all
documents hold is a list of bounded length in every shard.

Within a shard, each posting list is cut into blocks of similar documents: the documents of the
list go to the most similar of some documents of the same list. A block's summary holds, for every
term, the largest contribution of that term to any document of the block. The sum of a summary
over a query's terms bounds the scores of the block's documents, so a block is skipped only if
that bound is below the k-th best score so far, and a query stops once its remaining lists together
are. Both bounds are exact whole numbers: results are those of scoring everything.

Score, all in 64-bit whole numbers but the weight's logarithm:
w = floor(1000 ln((2N+2) / (2df+1))), m = 100 - b + (b n N) div L with b = 90, and
sum over the query's terms of w * ((10^9 tf) div (1000 tf + 8m)).

Defined results: null and empty texts have no terms; a query without terms that occur has no
rows. A query on several rows asks for the terms of all of them, null ids included; repeated
rows of a document are documents of their own. Equal scores go by the id, null last. Very long
texts are read whole. Empty tables give empty results. Other columns are not looked at.

Queries are taken in blocks of at most about ``QUERY_PAIRS`` (query, term) pairs, which bounds
what a task is sent; the documents are read again for each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from ..operators.staging import stage
from .blocks import ranges, unpack
from .byte_bpe import byte_slices
from .hashing import mix
from .shipping import map_batches
from .tables import with_fields

SHARD_DOCS = 4096
SHARD_BYTES = 16 << 20
BLOCK_DOCS = 64
DIRECTIONS = 16
QUERY_PAIRS = 1 << 17
LENGTH_PERCENT = 90

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TO_TERMS = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

_SHARD = (
    "n_docs bigint, n_terms bigint, keys binary, no_key binary, lengths binary, sizes binary, terms binary, counts binary"
)


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all bytes beyond ASCII, A-Z in lower case."""
    return text.translate(_TO_TERMS).split()


def _as_bytes(column: pa.Array) -> list[bytes]:
    return [text or b"" for text in column.cast(pa.large_binary()).to_pylist()]


def _query_terms(items: DataFrame, text: str, key: str) -> DataFrame:
    """(item, term) without repetition; term is binary."""
    chosen = items.select(F.col(key).alias("item"), F.col(text).alias("text"))
    schema = with_fields(chosen.select("item").schema, "term binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in _as_bytes(batch.column("text"))]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            terms = pa.array([t for f in found for t in f], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(at)), terms], ["item", "term"])

    return map_batches(chosen, run, schema).distinct()


def _shard(keys: list, lengths: list[int], found: list[np.ndarray], totals: tuple[int, int]) -> pa.RecordBatch:
    """One row: the documents that hold a term of the vocabulary, and their terms with counts."""
    kept = [i for i, terms in enumerate(found) if len(terms)]
    sizes, terms, counts = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in kept:
        own, times = np.unique(found[i], return_counts=True)
        sizes.append(len(own))
        terms.append(own)
        counts.append(times)
    own_keys = [keys[i] for i in kept]
    row = {
        "n_docs": totals[0],
        "n_terms": totals[1],
        "keys": np.array([0 if k is None else k for k in own_keys], np.int64).tobytes(),
        "no_key": bytes(k is None for k in own_keys),
        "lengths": np.array([lengths[i] for i in kept], np.int64).tobytes(),
        "sizes": np.array(sizes, np.int64).tobytes(),
        "terms": np.concatenate(terms).astype(np.int32).tobytes(),
        "counts": np.concatenate(counts).astype(np.int32).tobytes(),
    }
    types = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], list(row))


def index(docs: DataFrame, vocabulary: dict[bytes, int], text: str = "text", key: str = "doc_id") -> DataFrame:
    """Shards of an index of all of ``docs`` for the terms of ``vocabulary``; staged."""
    chosen = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, lengths, found, n_docs, size = [], [], [], 0, 0
        for batch in batches:
            for part in byte_slices(batch, "text"):
                for key, text in zip(part.column("key").to_pylist(), _as_bytes(part.column("text"))):
                    terms = terms_of(text)
                    keys.append(key)
                    lengths.append(len(terms))
                    own = list(map(vocabulary.__getitem__, filter(vocabulary.__contains__, terms)))
                    found.append(np.array(own, np.int32))
                    n_docs += bool(terms)
                    size += len(text)
                    if len(keys) >= SHARD_DOCS or size >= SHARD_BYTES:
                        yield _shard(keys, lengths, found, (n_docs, sum(lengths)))
                        keys, lengths, found, n_docs, size = [], [], [], 0, 0
        if keys:
            yield _shard(keys, lengths, found, (n_docs, sum(lengths)))

    return stage(map_batches(chosen, run, _SHARD))


def _document_counts(shards: DataFrame, terms: int) -> np.ndarray:
    """Number of documents that hold each term; as many rows as the query block has terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(terms, np.int64)
        for batch in batches:
            counts += np.bincount(unpack(pa.chunked_array([batch.column("terms")]), np.int32), minlength=terms)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["term", "n"])

    found = map_batches(shards.select("terms"), run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    result = np.zeros(terms, np.int64)
    for row in found.collect():
        result[row.term] = row.n
    return result


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_norms(lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m of documents of the given lengths."""
    if not len(lengths) or LENGTH_PERCENT * int(lengths.max()) * documents < 1 << 63:
        return 100 - LENGTH_PERCENT + LENGTH_PERCENT * lengths * documents // terms
    return np.array([100 - LENGTH_PERCENT + LENGTH_PERCENT * n * documents // terms for n in lengths.tolist()], np.int64)


class Blocks:
    """The blocks of one posting list: documents, and summaries of what they hold at most."""

    def __init__(self, docs: np.ndarray, shard: Shard):
        n = max(1, math.ceil(len(docs) / BLOCK_DOCS))
        centres = docs[np.arange(n) * len(docs) // n]
        nearest = np.argmax(shard.directions[docs] @ shard.directions[centres].T, axis=1)
        order = np.argsort(nearest, kind="stable")
        self.docs = docs[order]
        used, first = np.unique(nearest[order], return_index=True)
        self.starts = np.r_[first, len(docs)]
        # Every entry of every document of the list, by block and term.
        entries = ranges(shard.starts[self.docs], shard.sizes[self.docs])
        block = np.repeat(np.repeat(np.arange(len(used)), np.diff(self.starts)), shard.sizes[self.docs])
        place = block * shard.width + shard.terms[entries]
        by_place = np.argsort(place, kind="stable")
        place = place[by_place]
        new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        self.largest = np.maximum.reduceat(shard.parts[entries][by_place], new)
        self.terms = place[new] % shard.width
        self.summaries = np.searchsorted(place[new] // shard.width, np.arange(len(used)))

    def bounds(self, weights: np.ndarray) -> np.ndarray:
        """For each block, a score that none of its documents can exceed."""
        return np.add.reduceat(weights[self.terms] * self.largest, self.summaries)


class Best:
    """The k best (score, id) of one query so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.keys, self.no_key = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def to_beat(self) -> int:
        """Scores below this one cannot be among the best."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, keys: np.ndarray, no_key: np.ndarray) -> None:
        fine = scores >= self.to_beat
        if not fine.any():
            return
        scores = np.r_[self.scores, scores[fine]]
        keys, no_key = np.r_[self.keys, keys[fine]], np.r_[self.no_key, no_key[fine]]
        first = np.lexsort((keys, no_key, -scores))[: self.k]
        self.scores, self.keys, self.no_key = scores[first], keys[first], no_key[first]


class Shard:
    """Forward and inverted index of some documents, with the parts of scores that queries weigh."""

    def __init__(self, row: dict, weights: np.ndarray, documents: int, terms: int):
        self.keys = np.frombuffer(row["keys"], np.int64)
        self.no_key = np.frombuffer(row["no_key"], np.uint8).astype(bool)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.int32).astype(np.int64)
        self.width = len(weights)
        self.starts = np.r_[0, np.cumsum(self.sizes)[:-1]].astype(np.int64)
        self.owner = np.repeat(np.arange(len(self.keys)), self.sizes)
        counts = np.frombuffer(row["counts"], np.int32).astype(np.int64)
        norms = length_norms(np.frombuffer(row["lengths"], np.int64), documents, terms)
        self.parts = 1_000_000_000 * counts // (1000 * counts + 8 * norms[self.owner])
        by_term = np.argsort(self.terms, kind="stable")
        self._lists = self.owner[by_term]
        self._ends = np.cumsum(np.bincount(self.terms, minlength=self.width))
        self.largest = np.zeros(self.width, np.int64)
        np.maximum.at(self.largest, self.terms, self.parts)
        self._weights, self._blocks, self._directions = weights, {}, None

    @property
    def directions(self) -> np.ndarray:
        """Where documents point: weighted terms along fixed random signs, of length 1."""
        if self._directions is None:
            signs = (mix(np.arange(self.width, dtype=np.uint64) + np.uint64(1))[:, None] >> np.arange(DIRECTIONS, dtype=np.uint64)) & np.uint64(1)
            signs = signs.astype(np.float32) * 2 - 1
            weighed = (self._weights[self.terms] * self.parts).astype(np.float32)
            sums = np.add.reduceat(signs[self.terms] * weighed[:, None], self.starts, axis=0)
            self._directions = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-9)
        return self._directions

    def list(self, term: int) -> np.ndarray:
        return self._lists[self._ends[term - 1] if term else 0 : self._ends[term]]

    def blocks(self, term: int) -> Blocks:
        # Made when first asked for: most frequent terms never are.
        if term not in self._blocks:
            self._blocks[term] = Blocks(self.list(term), self)
        return self._blocks[term]

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        sizes = self.sizes[docs]
        entries = ranges(self.starts[docs], sizes)
        return np.add.reduceat(weights[self.terms[entries]] * self.parts[entries], np.r_[0, np.cumsum(sizes)[:-1]])

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Offer ``best`` what may be among the best for a query; returns how many documents were scored.

        ``weights`` holds those of the query's terms, and zeros.
        """
        most = weights[terms] * self.largest[terms]
        order = np.argsort(-most, kind="stable")
        terms, rest = terms[order], np.cumsum(most[order][::-1])[::-1].tolist()
        seen, scored = np.zeros(len(self.keys), bool), 0

        def look_at(docs: np.ndarray) -> None:
            nonlocal scored
            docs = docs[~seen[docs]]
            if len(docs):
                seen[docs] = True
                scored += len(docs)
                best.offer(self.scores(docs, weights), self.keys[docs], self.no_key[docs])

        for term, bound in zip(terms.tolist(), rest):
            # A document not seen yet holds none of the terms before.
            if bound < best.to_beat:
                break
            docs = self.list(term)
            if len(docs) <= BLOCK_DOCS:
                look_at(docs)
                continue
            blocks = self.blocks(term)
            bounds = blocks.bounds(weights)
            first = int(np.argmax(bounds))
            if bounds[first] < best.to_beat:
                continue
            look_at(blocks.docs[blocks.starts[first] : blocks.starts[first + 1]])
            others = np.flatnonzero(bounds >= best.to_beat)
            others = others[others != first]
            lengths = blocks.starts[others + 1] - blocks.starts[others]
            look_at(blocks.docs[ranges(blocks.starts[others], lengths)])
        return scored


def shards_of(batches: Iterator[pa.RecordBatch], weights: np.ndarray, documents: int, terms: int) -> Iterator[Shard]:
    """The shards of all rows. A caller that lets go of each holds one at a time."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            if row["keys"]:
                yield Shard(row, weights, documents, terms)


def _search_block(docs: DataFrame, queries: pa.Table, schema: StructType, k: int, text: str, key: str) -> DataFrame:
    """``schema``: (item, key, score) of the best of every task, for one block of queries."""
    names = queries["term"].to_pylist()
    vocabulary = {term: i for i, term in enumerate(sorted(set(names)))}
    encoded = queries["item"].combine_chunks().dictionary_encode(null_encoding="encode")
    items, of = encoded.dictionary, encoded.indices.to_numpy()
    order = np.argsort(of, kind="stable")
    asked = np.split(np.array([vocabulary[t] for t in names], np.int64)[order], np.cumsum(np.bincount(of))[:-1])

    shards = index(docs, vocabulary, text, key)
    totals = shards.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    documents, terms = totals.docs or 0, totals.terms or 0
    holding = _document_counts(shards, len(vocabulary))
    weights = np.array([term_weight(documents, n) if n else 0 for n in holding.tolist()], np.int64)
    weights.flags.writeable = False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, own = [Best(k) for _ in asked], np.zeros(len(weights), np.int64)
        for shard in shards_of(batches, weights, documents, terms):
            for query, found in zip(asked, best):
                own[query] = weights[query]
                shard.search(query[shard.largest[query] > 0], own, found)
                own[query] = 0
            del shard
        at = np.repeat(np.arange(len(best)), [len(b.keys) for b in best])
        yield pa.RecordBatch.from_arrays(
            [
                items.take(pa.array(at)),
                pa.array(np.concatenate([b.keys for b in best]), mask=np.concatenate([b.no_key for b in best])),
                pa.array(np.concatenate([b.scores for b in best])),
            ],
            ["item", "key", "score"],
        )

    return map_batches(shards, run, schema)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    query_pairs: int = QUERY_PAIRS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of every item, by rank."""
    pairs = stage(_query_terms(items, item_text, item_key))
    blocks = max(1, -(-pairs.count() // query_pairs))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    schema, found = with_fields(pairs.select("item").schema, "key bigint, score bigint"), None
    for number in range(blocks):
        queries = pairs.where(block == number).orderBy("item", "term").toArrow()  # about query_pairs rows
        if not queries.num_rows:
            continue
        part = _search_block(docs, queries, schema, k, text, key)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(F.col("item").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score")
    )
