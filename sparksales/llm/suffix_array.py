"""Substring dedup over bytes, with suffix arrays built by induced sorting.

Equal windows have to meet in one shard. A window's anchor is the stretch of
``GRAM`` bytes in it with the smallest name; regions of successive windows with one
anchor go to the shard of that name. Regions that are equal as a whole are counted and
need no sorting. Where regions with one anchor differ, one of each kind goes into the
shard's array, unless they are more than an array holds (``SHARD_BYTES``): those windows
go to the shard of their own name instead, once per block, and are counted there. Suffixes are classified as smaller or larger than their right neighbour,
the leftmost-smaller ones are sorted by their substrings, their names are sorted
recursively, and the order of all others is induced bucket by bucket, each bucket as
one vector. Common prefixes are computed in text order (permuted), capped at the window:
a start whose window is shared with a neighbour in the array is marked.

Defined results: null and empty texts have no bytes; fewer bytes than a window: nothing is
removed. Repeated rows are different documents, so all of them lose what they share. Ties
do not matter: every occurrence is marked. Extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import bucket_of, covered, in_order, joined_bytes, keys_and_kept, ranges, text_blocks
from .hashing import BYTE_NAMES, Stretches, combine, mix
from .repeats import CROWDED, OPEN, SENT_ARROW, classes, find_spans, grouped_windows, marked_starts, received, select, send
from .shipping import map_cogroups
from .tables import with_fields

WINDOW = 200
GRAM = 64
SLICE_BYTES = 1 << 18
SHARD_BYTES = 1 << 18
MOST_BUCKETS = 1024


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one behind it; the last character is the smallest."""
    steps = np.diff(text)
    change = np.flatnonzero(steps)
    smaller = np.ones(len(text), bool)
    if len(change):
        decided_at = np.searchsorted(change, np.arange(len(text) - 1))
        smaller[:-1] = steps[change[np.minimum(decided_at, len(change) - 1)]] > 0
    return smaller


def _place(target: np.ndarray, fill: np.ndarray, chars: np.ndarray, items: np.ndarray) -> None:
    """Append items to the buckets of their characters, in their order."""
    order = np.argsort(chars, kind="stable")
    chars, items = chars[order], items[order]
    first = np.flatnonzero(np.r_[True, chars[1:] != chars[:-1]])
    counts = np.diff(np.r_[first, len(chars)])
    nth = np.arange(len(chars)) - np.repeat(first, counts)
    target[fill[chars] + nth] = items
    fill[chars[first]] += counts


def _sweep(text, side, sizes, seeds, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """One inducing pass over the buckets: (suffixes of ``side`` by bucket, bucket starts).

    ``seeds(c)``: suffixes of the other side in bucket ``c``, in the order of the pass.
    """
    starts = np.r_[0, np.cumsum(sizes)]
    found, fill = np.empty(starts[-1], np.int64), starts[:-1].copy()
    characters = range(len(sizes) - 1, -1, -1) if backwards else range(len(sizes))
    for c in characters:
        done = starts[c]
        while True:
            batch = found[done : fill[c]]
            if not len(batch):
                break
            done = fill[c]
            _induce(text, side, found, fill, batch)
        _induce(text, side, found, fill, seeds(c))
    return found, starts


def _induce(text, side, found, fill, items) -> None:
    before = items[items > 0] - 1
    before = before[side[before]]
    if len(before):
        _place(found, fill, text[before], before)


def _induced(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, size: int) -> np.ndarray:
    """Order of all suffixes from an order of the leftmost-smaller ones."""
    char = text[leftmost]
    by_char = leftmost[np.argsort(char, kind="stable")]
    bounds = np.r_[0, np.cumsum(np.bincount(char, minlength=size))]
    larger_sizes = np.bincount(text[~smaller], minlength=size)
    smaller_sizes = np.bincount(text[smaller], minlength=size)
    larger, larger_at = _sweep(text, ~smaller, larger_sizes, lambda c: by_char[bounds[c] : bounds[c + 1]], False)
    small, small_at = _sweep(
        text, smaller, smaller_sizes, lambda c: larger[larger_at[c] : larger_at[c + 1]][::-1], True
    )
    # The last suffix has nothing behind it to be induced from; it is the smallest of all.
    order = np.empty(len(text), np.int64)
    at = np.r_[0, np.cumsum(larger_sizes + smaller_sizes)]
    for c in range(size):
        cut = at[c] + larger_sizes[c]
        order[at[c] : cut] = larger[larger_at[c] : larger_at[c + 1]]
        order[cut : at[c + 1]] = small[small_at[c] : small_at[c + 1]][::-1]
    return order


def _doubled(text: np.ndarray) -> np.ndarray:
    """Suffix order by doubling ranks; for texts with very many different characters."""
    rank, reach = text.astype(np.int64), 1
    while True:
        behind = np.zeros(len(rank), np.int64)
        behind[:-reach] = rank[reach:] + 1
        key = rank * (int(rank.max()) + 2) + behind
        order = np.argsort(key, kind="stable")
        new = np.r_[False, key[order][1:] != key[order][:-1]]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == len(rank) - 1 or reach >= len(rank):
            return order
        reach = min(2 * reach, len(rank) - 1) if len(rank) > 1 else len(rank)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of a sequence of small whole numbers, in order."""
    if len(text) < 2:
        return np.arange(len(text))
    return _sorted_suffixes(np.r_[text.astype(np.int64) + 1, 0])[1:]


def _sorted_suffixes(text: np.ndarray) -> np.ndarray:
    size = int(text.max()) + 1
    if size > MOST_BUCKETS:
        return _doubled(text)
    smaller = _types(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(leftmost) < 2:
        order = leftmost
    else:
        # The last one is the end mark, whose bucket of one is in place already.
        rough = _with_end(_induced(text, smaller, leftmost, size), text)
        is_leftmost = np.zeros(len(text), bool)
        is_leftmost[leftmost] = True
        by_substring = rough[is_leftmost[rough]]
        end = np.r_[leftmost[1:] + 1, len(text)]
        names = Stretches(text.astype(np.uint64) + np.uint64(1)).names(leftmost, end)
        place = np.searchsorted(leftmost, by_substring)
        named = names[place]
        rank = np.empty(len(leftmost), np.int64)
        rank[place] = np.cumsum(np.r_[False, named[1:] != named[:-1]])
        if rank.max() + 1 == len(leftmost):
            order = by_substring
        else:
            order = leftmost[_sorted_suffixes(rank)]
    return _with_end(_induced(text, smaller, order, size), text)


def _with_end(order: np.ndarray, text: np.ndarray) -> np.ndarray:
    order[0] = len(text) - 1
    return order


def shared_starts(data: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``starts`` begin a window of bytes that another of them begins too."""
    shared = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return shared
    is_start = np.zeros(len(data), bool)
    is_start[starts] = True
    order = suffix_array(data)
    order = order[is_start[order]]
    before = np.empty(len(data), np.int64)  # phi: the start before each one in the array
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    stretches = Stretches(BYTE_NAMES[data])
    here = np.sort(order)
    here = here[before[here] >= 0]
    common = np.zeros(len(here), np.int64)
    step = 1 << (window - 1).bit_length()
    while step:
        a, b = here + common, before[here] + common
        fits = (common + step <= window) & (np.maximum(a, b) + step <= len(data))
        a, b, at = a[fits], b[fits], np.flatnonzero(fits)
        same = stretches.raw(a, a + step) == stretches.raw(b, b + step)
        common[at[same]] += step
        step >>= 1
    mark = np.zeros(len(data), bool)
    equal = here[common >= window]
    mark[equal] = True
    mark[before[equal]] = True
    return mark[starts]


def _smallest_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of the ``width`` values from each position on, as far as they go."""
    table, reach = values, 1
    while 2 * reach <= width:
        table = np.minimum(table[:-reach], table[reach:]) if len(table) > reach else table[:0]
        reach *= 2
    over = width - reach
    return np.minimum(table[: len(table) - over], table[over:]) if len(table) > over else table[:0]


def byte_regions(data: np.ndarray, doc_start: np.ndarray, sizes: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """Regions of windows of texts that lie in ``data`` at ``doc_start``."""
    counts = np.maximum(sizes - window + 1, 0)
    start, owner = ranges(doc_start, counts), np.repeat(np.arange(len(sizes)), counts)
    if not len(start):
        start = np.zeros(0, np.int64)
        return {"name": start.astype(np.uint64), "content": start.astype(np.uint64), "row": start, "first": start, "last": start}
    stretches = Stretches(BYTE_NAMES[data])
    names = stretches.every(gram)
    keep = np.uint64((1 << 64) - (1 << 32))
    smallest = _smallest_ahead((names & keep) | np.arange(len(names), dtype=np.uint64), window - gram + 1)
    chosen = (smallest[start] & ~keep).astype(np.int64)
    first, last = grouped_windows(chosen, owner, start)
    a, b, anchor, row = start[first], start[last], chosen[first], owner[first]
    return {
        # Anchors are the smallest names around; mixed, they spread over all shards.
        "name": mix(names[anchor]),
        "content": combine(stretches.names(a, b + window), (anchor - a).astype(np.uint64)),
        "row": row,
        "first": a - doc_start[row],
        "last": b - doc_start[row],
    }


class Texts:
    """The texts of a block, in the block's own order of rows."""

    def __init__(self, table: pa.Table):
        self.table = in_order(table)
        self.data, starts = joined_bytes(self.table["text"])
        self.start, self.size = starts[:-1], np.diff(starts) - 1


def _regions(window: int, gram: int):
    def regions(block, table):
        t = Texts(table)
        data, parts, at = np.frombuffer(t.data, np.uint8), [], 0
        while at < len(t.start):
            end = max(at + 1, int(np.searchsorted(t.start, t.start[at] + SLICE_BYTES)))
            low, high = t.start[at], t.start[end - 1] + t.size[end - 1]
            part = byte_regions(data[low:high], t.start[at:end] - low, t.size[at:end], window, gram)
            part["row"] = part["row"] + at
            parts.append(part)
            at = end
        entries = {k: np.concatenate([part[k] for part in parts]) for k in parts[0]}
        entries |= {k: entries[k].astype(np.int32) for k in ("row", "first", "last")}
        entries["copies"] = np.ones(len(entries["row"]), np.int32)
        if not len(entries["row"]):
            return entries, entries
        order, new_class, _ = classes(entries["name"], entries["content"], [])
        size = np.diff(np.r_[np.flatnonzero(new_class), len(order)])
        of_class = np.cumsum(new_class) - 1
        repeated = order[size[of_class] > 1]
        entries["copies"][order[new_class]] = np.minimum(size, 2)
        decided = {k: entries[k][repeated] for k in ("row", "first", "last")}
        return decided, select(entries, order[new_class])

    return regions


def _decide(window: int):
    def decide(entries, crowded_names):
        if not len(entries["row"]):
            return {**entries}, {**entries}, {**entries}
        order, new_class, new_name = classes(entries["name"], entries["content"], [])
        head = np.flatnonzero(new_class)
        of_class = np.cumsum(new_class) - 1
        copies = np.add.reduceat(entries["copies"][order], head)
        repeated = order[copies[of_class] > 1]
        of_name, one = (np.cumsum(new_name) - 1)[head], order[head]
        sizes = entries["last"][one].astype(np.int64) - entries["first"][one] + window
        several = np.bincount(of_name)[of_name] > 1
        too_many = several & (np.bincount(of_name, sizes)[of_name] > SHARD_BYTES)
        crowded = too_many | np.isin(entries["name"][one], crowded_names)
        open_ = one[several & ~crowded]
        decided = {k: entries[k][repeated] for k in ("row", "first", "last", "origin")}
        places = {k: entries[k][one[crowded]] for k in ("row", "first", "last", "origin")}
        return decided, {k: entries[k][open_] for k in ("name", "row", "first", "last", "origin")}, places

    return decide


def _window_names(t: Texts, low: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Names of ``counts`` successive windows from each position ``low`` on."""
    sizes = counts + window - 1
    so_far, names, at = np.cumsum(sizes), [np.zeros(0, np.uint64)], 0
    while at < len(low):
        done = so_far[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(so_far, done + SLICE_BYTES, side="right")))
        body = b"".join([t.data[a : a + n] for a, n in zip(low[at:end].tolist(), sizes[at:end].tolist())])
        starts = ranges(so_far[at:end] - sizes[at:end] - done, counts[at:end])
        names.append(Stretches(BYTE_NAMES[np.frombuffer(body, np.uint8)]).names(starts, starts + window))
        at = end
    return np.concatenate(names)


def _counted_windows(t: Texts, entries, window: int):
    """Of the windows of crowded regions, the repeated ones as spans, and one of each name."""
    first = entries["first"].astype(np.int64)
    counts = entries["last"] - first + 1
    name = _window_names(t, t.start[entries["row"]] + first, counts, window)
    row, start = np.repeat(entries["row"], counts), ranges(first, counts).astype(np.int32)
    order = np.argsort(name, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = name[order][1:] != name[order][:-1]
    of_name = np.cumsum(new) - 1
    one, again = order[new], np.sort(order[np.bincount(of_name)[of_name] > 1])
    a, b = grouped_windows(row[again], row[again], start[again])
    decided = {"row": row[again[a]], "first": start[again[a]], "last": start[again[b]]}
    return decided, {"name": name[one], "row": row[one], "first": start[one]}


def _extract(window: int, buckets: int):
    def extract(block, table, entries, crowded):
        t = Texts(table)
        to = bucket_of(entries["name"], buckets)
        order = np.argsort(to, kind="stable")
        low = t.start[entries["row"]] + entries["first"]
        high = t.start[entries["row"]] + entries["last"] + window
        rows = []
        for some in np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(order) else []:
            body = b"".join([t.data[a:b] for a, b in zip(low[some].tolist(), high[some].tolist())])
            packed = {k: entries[k][some].tobytes() for k in ("name", "row", "first", "last")}
            rows.append({"bucket": int(to[some[0]]), "kind": OPEN, "origin": block, "body": body, **packed})
        empty = {name: b"" for name in SENT_ARROW.names}
        decided, windows = _counted_windows(t, crowded, window)
        counted = send(CROWDED, block, bucket_of(windows["name"], buckets), windows)
        return decided, [pa.Table.from_pylist([empty | row for row in rows], SENT_ARROW), counted]

    return extract


def _sent_by_several(entries) -> np.ndarray:
    """Which windows came from more than one block."""
    order = np.argsort(entries["name"], kind="stable")
    name = entries["name"][order]
    like_next = name[1:] == name[:-1]
    return order[np.r_[like_next, False] | np.r_[False, like_next]] if len(order) else order


def _compare(window: int):
    def compare(table):
        counted = received(table, CROWDED)
        of = _sent_by_several(counted)
        several = {k: counted[k][of] for k in ("row", "first", "origin")}
        several["last"] = several["first"]
        entries = received(table, OPEN)
        counts = entries["last"].astype(np.int64) - entries["first"] + 1
        sizes = counts + window - 1
        begin = np.cumsum(sizes) - sizes
        # Regions of different names share no window, so arrays of a few names at a time do.
        order = np.lexsort((entries["first"], entries["row"], entries["origin"], entries["name"]))
        name, so_far = entries["name"][order], np.cumsum(sizes[order])
        ends = np.flatnonzero(np.r_[name[1:] != name[:-1], True]) + 1 if len(order) else order
        marked, at = [(order[:0], order[:0])], 0
        while at < len(order):
            done = so_far[at - 1] if at else 0
            end = ends[np.searchsorted(ends, at, side="right")]
            more = ends[max(0, np.searchsorted(so_far[ends - 1], done + SHARD_BYTES, side="right") - 1)]
            some = order[at : max(end, more)]
            at = max(end, more)
            data = entries["body"][ranges(begin[some], sizes[some])]
            low = np.cumsum(sizes[some]) - sizes[some]
            shared = shared_starts(data, ranges(low, counts[some]), window)
            of = np.repeat(some, counts[some])[shared]
            start = ranges(entries["first"][some].astype(np.int64), counts[some])[shared]
            marked.append((of, start))
        of, start = (np.concatenate(part) for part in zip(*marked))
        start = start.astype(np.int32)
        found = {"row": entries["row"][of], "first": start, "last": start, "origin": entries["origin"][of]}
        return {k: np.concatenate([found[k], several[k]]) for k in found}

    return compare


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    text: str = "text",
    key: str = "doc_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(key, ``keep``..., n_bytes, n_removed, removed, kept) of every row of ``docs``.

    ``removed``: array of (start, end) byte positions, end exclusive; ``kept``: the bytes
    that stay. ``gram`` is at most ``window``.
    """
    blocks, buckets = text_blocks(docs, text, key, keep)
    gram = min(gram, window)
    spans = find_spans(
        blocks, buckets, _regions(window, gram), _decide(window), _extract(window, buckets), _compare(window)
    )
    others = [name for name in docs.columns if name in keep and name != key]
    schema = with_fields(
        docs.select(key, *others).schema,
        "n_bytes bigint, n_removed bigint, removed array<struct<start: int, end: int>>, kept binary",
    )

    def finish(texts, answers):
        t = Texts(texts)
        row, first, last = marked_starts(answers)
        data = np.frombuffer(t.data, np.uint8)
        gone = covered(t.start[row] + first, t.start[row] + last + window, len(data))
        removed, spans_of, kept = [], [], []
        for a, n in zip(t.start.tolist(), t.size.tolist()):
            mask = gone[a : a + n]
            count_ = int(mask.sum())
            removed.append(count_)
            if not count_:
                spans_of.append([])
                kept.append(t.data[a : a + n])
                continue
            steps = np.diff(np.r_[0, mask.view(np.int8), 0])
            bounds = zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist())
            spans_of.append([{"start": s, "end": e} for s, e in bounds])
            kept.append(data[a : a + n][~mask].tobytes())
        columns = keys_and_kept(t.table, others, text)
        columns += [pa.array(t.size, pa.int64()), pa.array(removed, pa.int64())]
        columns.append(pa.array(spans_of, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
        columns.append(pa.array(kept, pa.binary()))
        return pa.table(columns, names=schema.names)

    return map_cogroups(blocks, spans, ["block"], finish, schema)
