"""Substring dedup over words, by recompression.

Words become names. In each round, runs of equal names and pairs of neighbours get one
new name each, computed from what they consist of, so every task names equal stretches
alike without asking another. Which neighbours form a pair depends on one random bit per
name and round: a 0 followed by a 1.

Every symbol knows its support: the words that its existence depends on, the
neighbours included that it could have joined and did not. A symbol whose support lies
inside a window is interior to it and appears in every other occurrence of the window,
at the same place. Of its interior symbols of the highest level a window takes the one
with the smallest name as anchor (a word is its own support, so there is one). Shared
anchors reveal possible repeats; the names of whole regions and windows verify them.

Defined results: null and empty texts have no words. Fewer words than a window: nothing
is removed. An occurrence is earlier if its (doc_id, start) is smaller, null ids first;
rows with equal ids are the same document to that order, so equal rows keep and lose the
same words. Extra columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import bucket_of, covered, in_order, joined_bytes, keys_and_kept, numbers, ranges, text_blocks
from .hashing import Stretches, combine, mix, word_names
from .repeats import OPEN, classes, find_spans, grouped_windows, marked_starts, received, select, send
from .shipping import map_cogroups
from .tables import with_fields

WINDOW = 20
ROUNDS = 2
_RUN, _PAIR, _BIT = 101, 211, 307


class Symbols:
    """One level: names, first words, and supports [low, high) of consecutive symbols."""

    def __init__(self, name, start, low, high, owner):
        self.name, self.start, self.low, self.high, self.owner = name, start, low, high, owner


def _neighbours(s: Symbols, doc_first: np.ndarray, doc_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the support reaches if the left (right) neighbour counts; beyond the text at its edges."""
    alone = np.r_[True, s.owner[1:] != s.owner[:-1]]
    left = np.where(alone, doc_first[s.owner] - 1, np.r_[0, s.low[:-1]])
    last = np.r_[alone[1:], True]
    right = np.where(last, doc_end[s.owner] + 1, np.r_[s.high[1:], 0])
    return left, right


def name_runs(s: Symbols, doc_first: np.ndarray, doc_end: np.ndarray) -> Symbols:
    """Every maximal run of equal names as one symbol."""
    if not len(s.name):
        return s
    left, right = _neighbours(s, doc_first, doc_end)
    new = np.r_[True, (s.name[1:] != s.name[:-1]) | (s.owner[1:] != s.owner[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(s.name)] - 1
    length = (last - first + 1).astype(np.uint64)
    name = np.where(length > 1, combine(s.name[first], length, _RUN), s.name[first])
    return Symbols(name, s.start[first], left[first], right[last], s.owner[first])


def name_pairs(s: Symbols, doc_first: np.ndarray, doc_end: np.ndarray, round_: int) -> Symbols:
    """Every 0 followed by a 1 as one symbol."""
    if not len(s.name):
        return s
    left, right = _neighbours(s, doc_first, doc_end)
    bit = (mix(s.name + np.uint64(_BIT + round_)) & np.uint64(1)).astype(bool)
    joins = np.r_[~bit[:-1] & bit[1:] & (s.owner[1:] == s.owner[:-1]), False]
    joined = np.r_[False, joins[:-1]]
    # A lone 0 has seen that its right neighbour is no 1, a lone 1 that its left one is no 0.
    low = np.where(bit, left, s.low)
    high = np.where(bit, s.high, right)
    head = np.flatnonzero(~joined)
    pair = joins[head]
    tail = np.minimum(head + 1, len(s.name) - 1)
    return Symbols(
        np.where(pair, combine(s.name[head], s.name[tail], _PAIR), s.name[head]),
        s.start[head],
        np.where(pair, s.low[head], low[head]),
        np.where(pair, s.high[tail], high[head]),
        s.owner[head],
    )


def levels(names: np.ndarray, owner: np.ndarray, doc_first: np.ndarray, doc_end: np.ndarray, rounds: int) -> list[Symbols]:
    at = np.arange(len(names))
    found = [Symbols(names, at, at, at + 1, owner)]
    for round_ in range(rounds):
        runs = name_runs(found[-1], doc_first, doc_end)
        found.append(name_pairs(runs, doc_first, doc_end, round_))
    return found


def _smallest(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Smallest of values[first..last] for each range, by doubling."""
    result = np.empty(len(first), values.dtype)
    power = np.frexp((last - first + 1).astype(float))[1] - 1
    table = values
    for p in range(int(power.max()) + 1 if len(power) else 0):
        mine = np.flatnonzero(power == p)
        result[mine] = np.minimum(table[first[mine]], table[last[mine] - (1 << p) + 1])
        table = np.minimum(table[: -(1 << p)], table[1 << p :]) if len(table) > 1 << p else table[:0]
    return result


def anchors(found: list[Symbols], window: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window start: (a number for the anchor, its name, its first word).

    The name is that of the words of the support, which stand in every window that takes
    the anchor; far fewer unrelated windows share it than share the symbol.
    """
    stretches = Stretches(found[0].name)
    number = np.full(len(start), -1, np.int64)
    name, word = np.zeros(len(start), np.uint64), np.zeros(len(start), np.int64)
    base = 0
    for level in range(len(found) - 1, -1, -1):
        s, todo = found[level], np.flatnonzero(number < 0)
        if not len(todo):
            break
        first = np.searchsorted(s.low, start[todo], side="left")
        last = np.searchsorted(s.high, start[todo] + window, side="right") - 1
        some = last >= first
        todo, first, last = todo[some], first[some], last[some]
        bits = max(24, int(len(s.name)).bit_length())
        keep = np.uint64((1 << 64) - (1 << bits))
        # Ties of the upper bits go to the first symbol, which is the same in every occurrence.
        ranked = (s.name & keep) | np.arange(len(s.name), dtype=np.uint64)
        chosen = (_smallest(ranked, first, last) & ~keep).astype(np.int64)
        number[todo] = chosen + base
        low, high = s.low[chosen], s.high[chosen]
        name[todo] = combine(stretches.names(low, high), (s.start[chosen] - low).astype(np.uint64), level)
        word[todo] = s.start[chosen]
        base += len(s.name)
    return number, name, word


class Words:
    """The words of a block's texts, in the block's own order of rows."""

    def __init__(self, table: pa.Table):
        self.table = in_order(table)
        self.data, starts = joined_bytes(self.table["text"])
        self.start, self.end, self.name = word_names(np.frombuffer(self.data, np.uint8))
        self.owner = np.searchsorted(starts, self.start, side="right") - 1
        self.doc_first = np.searchsorted(self.owner, np.arange(len(starts) - 1), side="left")
        self.doc_end = np.searchsorted(self.owner, np.arange(len(starts) - 1), side="right")
        self.doc_key = numbers(self.table["doc_key"])


def _regions(window: int, rounds: int):
    def regions(block, table):
        w = Words(table)
        counts = np.maximum(w.doc_end - w.doc_first - window + 1, 0)
        start = ranges(w.doc_first, counts)
        owner = w.owner[start] if len(start) else start
        found = levels(w.name, w.owner, w.doc_first, w.doc_end, rounds)
        number, name, word = anchors(found, window, start)
        first, last = grouped_windows(number, owner, start)
        stretches = Stretches(w.name)
        content = combine(
            stretches.names(start[first], start[last] + window), (word[first] - start[first]).astype(np.uint64)
        )
        row = owner[first]
        entries = {
            "name": name[first],
            "content": content,
            "doc_key": w.doc_key[row],
            "row": row.astype(np.int32),
            "first": (start[first] - w.doc_first[row]).astype(np.int32),
            "last": (start[last] - w.doc_first[row]).astype(np.int32),
        }
        if not len(first):
            return entries, entries
        later, earliest, _ = _later_ones(entries)
        # Equal rows stand at the same place of the order; each has to be told.
        decided = {key: entries[key][later] for key in ("row", "first", "last")}
        return decided, select(entries, earliest)

    return regions


def _later_ones(entries, crowded_names=()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices of entries later than the first of their class, of the others, and of firsts of names with several classes or crowded ones."""
    order, new_class, new_name = classes(entries["name"], entries["content"], [entries["doc_key"], entries["first"]])
    key, start = entries["doc_key"][order], entries["first"][order]
    head = np.flatnonzero(new_class)
    of_class = np.cumsum(new_class) - 1
    later = (key != key[head][of_class]) | (start != start[head][of_class])
    of_name = np.cumsum(new_name) - 1
    several = np.bincount(of_name[head])[of_name] > 1
    several |= np.isin(entries["name"][order], crowded_names)
    return order[later], order[~later], order[~later & several]


def _decide(entries, crowded_names):
    if not len(entries["row"]):
        return {**entries}, {**entries}, {**entries}
    later, _, open_ = _later_ones(entries, crowded_names)
    decided = {key: entries[key][later] for key in ("row", "first", "last", "origin")}
    # All that is open is compared by windows; no name needs to be told apart.
    none = {key: entries[key][:0] for key in ("row", "origin")}
    return decided, {key: entries[key][open_] for key in ("doc_key", "row", "first", "last", "origin")}, none


def _extract(window: int, buckets: int):
    def extract(block, table, open_, crowded):
        w = Words(table)
        entries = {key: np.concatenate([open_[key], crowded[key]]) for key in ("doc_key", "row", "first", "last")}
        size = entries["last"].astype(np.int64) - entries["first"] + 1
        start = ranges(entries["first"].astype(np.int64), size)
        row = np.repeat(entries["row"], size)
        at = start + w.doc_first[row]
        name = Stretches(w.name).names(at, at + window)
        windows = {
            "name": name,
            "doc_key": np.repeat(entries["doc_key"], size),
            "row": row,
            "first": start.astype(np.int32),
            "last": start.astype(np.int32),
        }
        if not len(row):
            return windows, []
        # What stands earlier in the block itself need not travel to be found out.
        windows["content"] = np.zeros(len(row), np.uint64)
        later, earliest, _ = _later_ones(windows)
        windows.pop("content")
        decided = {key: windows[key][later] for key in ("row", "first", "last")}
        return decided, [send(OPEN, block, bucket_of(name[earliest], buckets), select(windows, earliest))]

    return extract


def _compare(table):
    entries = received(table, OPEN)
    if not len(entries["row"]):
        return entries
    entries["content"] = np.zeros(len(entries["row"]), np.uint64)
    later, _, _ = _later_ones(entries)
    return {key: entries[key][later] for key in ("row", "first", "last", "origin")}


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    rounds: int = ROUNDS,
    text: str = "text",
    key: str = "doc_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(key, ``keep``..., n_words, n_removed, removed, kept_text) of every row of ``docs``.

    ``removed``: array of (start, end) word positions, end exclusive; ``kept_text``:
    the words that stay, joined by single spaces, as binary UTF-8.
    """
    blocks, buckets = text_blocks(docs, text, key, keep)
    spans = find_spans(
        blocks,
        buckets,
        _regions(window, rounds),
        _decide,
        _extract(window, buckets),
        _compare,
    )
    others = [name for name in docs.columns if name in keep and name != key]
    schema = with_fields(
        docs.select(key, *others).schema,
        "n_words bigint, n_removed bigint, removed array<struct<start: int, end: int>>, kept_text binary",
    )

    def finish(texts, answers):
        w = Words(texts)
        row, first, last = marked_starts(answers)
        gone = covered(w.doc_first[row] + first, w.doc_first[row] + last + window, len(w.start))
        n_words, removed, spans_of, kept_text = w.doc_end - w.doc_first, [], [], []
        for a, b in zip(w.doc_first.tolist(), w.doc_end.tolist()):
            mask = gone[a:b]
            removed.append(int(mask.sum()))
            steps = np.diff(np.r_[0, mask.astype(np.int8), 0])
            bounds = zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist())
            spans_of.append([{"start": s, "end": e} for s, e in bounds])
            stay = np.flatnonzero(~mask) + a
            words = zip(w.start[stay].tolist(), w.end[stay].tolist())
            kept_text.append(b" ".join([w.data[s:e] for s, e in words]))
        columns = keys_and_kept(w.table, others, text)
        columns += [pa.array(n_words, pa.int64()), pa.array(removed, pa.int64())]
        columns.append(pa.array(spans_of, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
        columns.append(pa.array(kept_text, pa.binary()))
        return pa.table(columns, names=schema.names)

    return map_cogroups(blocks, spans, ["block"], finish, schema)
