"""Language-model scores of documents by stupid backoff over corpus counts.

score(w | context) is f(context w) / f(context) where the n-gram occurs, and otherwise
``alpha`` times the score with a context one word shorter; f(w) / N for a single word. A
document is scored by the other documents: its own occurrences are taken off all counts,
so what only itself contains backs off.

Relations: documents are dealt to blocks; every block sends its distinct n-grams with
their counts to hash buckets (the count table, by name); a bucket adds up the counts of
each name and joins them back to the n-grams that asked; every block sums the logarithms
of its documents. All counts cover the whole corpus, and grow with it. An n-gram that is
in every document is one entry per block.

Defined results: null and empty texts have no words, no score and count nowhere. A text
that is alone in the corpus has only backed-off words; a word that no other document has
is counted as if it had occurred ``unseen`` times. Repeated rows are different documents
and know each other's words. Extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import bucket_of, in_order, joined_bytes, keys_and_kept, numbers, text_blocks
from .hashing import Stretches, mix, word_names
from .shipping import map_cogroups, map_groups
from .tables import with_fields

ORDER = 2
ALPHA = 0.4
UNSEEN = 0.5
PART_NAMES = 1 << 18

_ASKED = "bucket int, origin int, names binary, counts binary"
_ASKED_ARROW = pa.schema(
    [("bucket", pa.int32()), ("origin", pa.int32()), ("names", pa.binary()), ("counts", pa.binary())]
)
_TOLD = "block int, bucket int, counts binary"
_TOLD_ARROW = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary())])
EMPTY = mix(np.zeros(1, np.uint64) + np.uint64(99))


class Grams:
    """The n-grams of a block: one array of names for each length, with their documents."""

    def __init__(self, table: pa.Table, order: int):
        self.table = in_order(table)
        data, starts = joined_bytes(self.table["text"])
        first, _, words = word_names(np.frombuffer(data, np.uint8))
        self.owner = np.searchsorted(starts, first, side="right") - 1
        self.docs = len(starts) - 1
        self.n_words = np.bincount(self.owner, minlength=self.docs)
        stretches, n, at = Stretches(words), len(words), np.arange(len(words))
        self.names, self.inside = [], []
        for length in range(1, order + 1):
            end = np.minimum(at + length, n)
            inside = (at + length <= n) & (self.owner[np.maximum(end - 1, 0)] == self.owner) if n else np.zeros(0, bool)
            names = np.zeros(n, np.uint64)
            names[inside] = mix(stretches.names(at[inside], end[inside]) + np.uint64(length))
            self.names.append(names)
            self.inside.append(inside)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Names in order, with counts. The empty n-gram stands before every word."""
        every = [names[inside] for names, inside in zip(self.names, self.inside)]
        names, counts = np.unique(np.concatenate([*every, EMPTY]), return_counts=True)
        counts[np.searchsorted(names, EMPTY[0])] += len(self.owner) - 1
        return names, counts.astype(np.uint64)


def planes(values: np.ndarray) -> bytes:
    """64-bit numbers byte by byte of significance, so that small ones compress."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def deltas(names: np.ndarray) -> bytes:
    """Sorted names as their differences."""
    return planes(np.diff(names, prepend=np.uint64(0)))


def from_deltas(packed: bytes) -> np.ndarray:
    return np.cumsum(from_planes(packed), dtype=np.uint64)


def _ask(order: int, buckets: int):
    def ask(key, table):
        names, counts = Grams(table, order).distinct()
        to = bucket_of(names, buckets)
        bounds = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, np.int64)
        ends = np.r_[bounds[1:], len(to)]
        block = key[0].as_py()
        rows = {
            "bucket": to[bounds].tolist(),
            "origin": [block] * len(bounds),
            "names": [deltas(names[a:b]) for a, b in zip(bounds, ends)],
            "counts": [planes(counts[a:b]) for a, b in zip(bounds, ends)],
        }
        return pa.table(rows, schema=_ASKED_ARROW)

    return ask


def _add_up(table):
    """Total count of every name, back to each block that has it, in the order of its names."""
    names = [from_deltas(packed) for packed in table["names"].to_pylist()]
    counts = [from_planes(packed) for packed in table["counts"].to_pylist()]
    totals = [np.empty(len(own), np.uint64) for own in names]
    low, high = min(int(own[0]) for own in names), max(int(own[-1]) for own in names) + 1
    parts = max(1, sum(map(len, names)) // PART_NAMES)
    for part in range(parts):
        # One range of names at a time, so that sorting takes little memory.
        first, last = (low + (high - low) * (part + i) // parts for i in range(2))
        cuts = [[int(np.searchsorted(own, np.uint64(edge))) if edge <= own[-1] else len(own) for edge in (first, last)] for own in names]
        distinct, at = np.unique(np.concatenate([own[a:b] for own, (a, b) in zip(names, cuts)]), return_inverse=True)
        sums = np.zeros(len(distinct), np.uint64)
        np.add.at(sums, at, np.concatenate([own[a:b] for own, (a, b) in zip(counts, cuts)]))
        done = 0
        for own, (a, b) in zip(totals, cuts):
            own[a:b] = sums[at[done : done + b - a]]
            done += b - a
    return pa.table(
        {"block": numbers(table["origin"]), "bucket": numbers(table["bucket"]), "counts": [planes(own) for own in totals]},
        schema=_TOLD_ARROW,
    )


def own_counts(names: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """How often the n-gram at each place occurs in its document."""
    if not len(names):
        return np.zeros(0, np.int64)
    order = np.lexsort((names, owner))
    new = np.r_[True, (owner[order][1:] != owner[order][:-1]) | (names[order][1:] != names[order][:-1])]
    first = np.flatnonzero(new)
    sizes = np.diff(np.r_[first, len(order)])
    result = np.empty(len(order), np.int64)
    result[order] = np.repeat(sizes, sizes)
    return result


def log_scores(grams: Grams, names: np.ndarray, totals: np.ndarray, words: float, alpha: float, unseen: float) -> np.ndarray:
    """Natural logarithm of the score of every word."""
    counts = []
    for own_names, inside in zip(grams.names, grams.inside):
        count = np.zeros(len(own_names))
        count[inside] = totals[np.searchsorted(names, own_names[inside])]
        count[inside] -= own_counts(own_names[inside], grams.owner[inside])
        counts.append(count)  # in other documents, by the first word of the n-gram
    others = np.maximum(words - grams.n_words[grams.owner], 1)
    result = np.log(np.maximum(counts[0], unseen) / others)
    for length in range(2, len(counts) + 1):
        # The n-gram that ends at a word starts length - 1 words before it.
        whole, context = np.zeros(len(result)), np.ones(len(result))
        back = length - 1
        whole[back:] = np.where(grams.inside[length - 1][:-back], counts[length - 1][:-back], 0)
        context[back:] = np.maximum(counts[length - 2][:-back], 1)
        starts = np.r_[True, grams.owner[1:] != grams.owner[:-1]]
        nth = np.arange(len(result)) - np.maximum.accumulate(np.where(starts, np.arange(len(result)), 0))
        longer = np.log(np.maximum(whole, 1) / context)
        backed = result + np.log(alpha)
        result = np.where(nth < back, result, np.where(whole > 0, longer, backed))
    return result


def scores(
    docs: DataFrame,
    order: int = ORDER,
    alpha: float = ALPHA,
    unseen: float = UNSEEN,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every row; scores are null without words."""
    blocks, buckets = text_blocks(docs, text, key)
    asked = map_groups(blocks, ["block"], _ask(order, buckets), _ASKED)
    told = map_groups(asked, ["bucket"], _add_up, _TOLD)
    schema = with_fields(docs.select(F.col(key).alias("doc_id")).schema, "n_words bigint, log_score double, mean_log_score double")

    def sum_up(texts, totals):
        grams = Grams(texts, order)
        names, _ = grams.distinct()
        totals = totals.take(np.argsort(numbers(totals["bucket"]), kind="stable"))
        counts = np.concatenate([from_planes(c) for c in totals["counts"].to_pylist()]).astype(np.float64)
        words = counts[np.searchsorted(names, EMPTY[0])]
        logs = log_scores(grams, names, counts, words, alpha, unseen)
        sums = np.bincount(grams.owner, logs, grams.docs)
        n = grams.n_words
        some = n > 0
        mean = sums / np.maximum(n, 1)
        return pa.table(
            [
                *keys_and_kept(grams.table, [], text),
                pa.array(n, pa.int64()),
                pa.array(sums, pa.float64(), mask=~some),
                pa.array(mean, pa.float64(), mask=~some),
            ],
            names=schema.names,
        )

    return map_cogroups(blocks, told, ["block"], sum_up, schema)
