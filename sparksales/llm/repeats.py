"""What the two substring-dedup operators share: anchors, region classes, and spans.

A window is a fixed number of units (words or bytes) of one document. Each window
chooses an anchor inside itself by a rule that looks at the window alone, so equal
windows choose equal anchors at the same place. Successive windows with one anchor make
a region. Regions travel to a bucket by their anchor's name:

* regions equal in name and content form a class; what holds for all but the first of a
  class, or for all of a class of two or more, is decided from counts;
* only where one name has several classes, one region of each class goes on to be
  compared window by window.

Inside a block, classes are formed before anything is sent. A passage that a third of
all documents share is sent once per block, not once per document.

Regions at the edges of such a passage differ, because they reach into what surrounds it,
and still have one anchor. A name with more than ``MOST_CLASSES`` classes in a block is
crowded: the block keeps the regions to itself and sends the name alone. Regions of
crowded names are compared window by window under the windows' own names, of which a
block sends each once. So what meets under one name grows with the blocks, not with the
documents.

Packed rows carry ``kind``: a span that is already decided rides along unchanged, and so
do the regions that a block keeps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import bucket_of, entries_per_row, numbers, pack, unpack
from .shipping import map_cogroups, map_groups

DECIDED, OPEN, CROWDED, NAMED = range(4)
MOST_CLASSES = 32

# origin: block of the document; row: its place in the block; first, last: window starts.
FIELDS = {
    "name": np.uint64,
    "content": np.uint64,
    "doc_key": np.int64,
    "copies": np.int32,
    "row": np.int32,
    "first": np.int32,
    "last": np.int32,
}
_BINARY = [*FIELDS, "body"]  # body: the units themselves, where they have to be compared
SENT = "bucket int, kind int, origin int, " + ", ".join(f"{name} binary" for name in _BINARY)
SENT_ARROW = pa.schema(
    [("bucket", pa.int32()), ("kind", pa.int32()), ("origin", pa.int32()), *[(name, pa.binary()) for name in _BINARY]]
)


def grouped_windows(chosen: np.ndarray, owner: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of successive windows with one anchor in one document."""
    if not len(chosen):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(np.r_[True, new])
    return first, np.r_[first[1:], len(chosen)] - 1


def classes(name: np.ndarray, content: np.ndarray, then: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (name, content, *then); in it, where classes start and where names start."""
    order = np.lexsort((*then[::-1], content, name))
    name, content = name[order], content[order]
    new_name = np.r_[True, name[1:] != name[:-1]]
    new_class = new_name | np.r_[True, content[1:] != content[:-1]]
    return order, new_class, new_name


def send(kind: int, block: int, to: np.ndarray, entries: dict[str, np.ndarray]) -> pa.Table:
    return pack(SENT_ARROW, to, {"kind": kind, "origin": block}, entries)


def received(table: pa.Table, kind: int) -> dict[str, np.ndarray]:
    """Entries of one kind, with ``origin``, in an order that does not depend on arrival."""
    table = table.filter(pa.array(numbers(table["kind"]) == kind))
    table = table.take(np.argsort(numbers(table["origin"]), kind="stable"))
    entries = {name: unpack(table[name], dtype) for name, dtype in FIELDS.items()}
    entries["origin"] = np.repeat(numbers(table["origin"]), entries_per_row(table["row"], np.int32))
    entries["body"] = unpack(table["body"], np.uint8)
    return entries


def select(entries: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
    return {name: values[at] for name, values in entries.items() if len(values)}


def answer(kind: int, entries: dict[str, np.ndarray]) -> pa.Table:
    """Entries on their way back to the blocks they came from."""
    entries = dict(entries)
    origin = entries.pop("origin", np.zeros(0, np.int32))
    entries.pop("body", None)
    return pack(SENT_ARROW, origin.astype(np.int32), {"kind": kind, "origin": 0}, entries)


def to_blocks(sent: DataFrame) -> DataFrame:
    return sent.withColumnRenamed("bucket", "block")


def in_many_classes(name: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Whether an entry's name has more than ``MOST_CLASSES`` classes."""
    order, new_class, new_name = classes(name, content, [])
    of_name = np.cumsum(new_name) - 1
    many = np.empty(len(name), bool)
    many[order] = (np.bincount(of_name[new_class]) > MOST_CLASSES)[of_name]
    return many


def steps(buckets: int, regions, decide, extract, compare):
    """What is done to blocks, buckets, blocks and buckets again; see ``find_spans``."""

    def own(block: int, entries) -> np.ndarray:
        return np.full(len(entries["row"]), block % buckets, np.int32)

    def first(key, table):
        block = key[0].as_py()
        decided, open_ = regions(block, table)
        tables = [send(DECIDED, block, own(block, decided), decided)]
        if len(open_["row"]):
            many = in_many_classes(open_["name"], open_["content"])
            few, names = select(open_, ~many), np.unique(open_["name"][many])
            kept = {name: open_[name][many] for name in ("doc_key", "row", "first", "last") if name in open_}
            tables.append(send(OPEN, block, bucket_of(few["name"], buckets), few))
            tables.append(send(NAMED, block, bucket_of(names, buckets), {"name": names}))
            tables.append(send(CROWDED, block, own(block, kept), kept))
        return pa.concat_tables(tables)

    def second(table):
        named = table.filter(pa.array(numbers(table["kind"]) == NAMED))
        decided, open_, crowded = decide(received(table, OPEN), np.unique(unpack(named["name"], np.uint64)))
        tables = [answer(DECIDED, decided), answer(OPEN, open_), answer(CROWDED, crowded)]
        return pa.concat_tables(tables + [answer(kind, received(table, kind)) for kind in (DECIDED, CROWDED)])

    def third(key, texts, answers):
        block = key[0].as_py()
        answers = answers.rename_columns(["bucket", *answers.column_names[1:]])
        before = received(answers, DECIDED)
        before.pop("origin"), before.pop("body")
        tables = [send(DECIDED, block, own(block, before), before)]
        open_, crowded = received(answers, OPEN), received(answers, CROWDED)
        if len(open_["row"]) or len(crowded["row"]):
            decided, sent = extract(block, texts, open_, crowded)
            tables += [send(DECIDED, block, own(block, decided), decided), *sent]
        return pa.concat_tables(tables)

    def fourth(table):
        return pa.concat_tables([answer(DECIDED, received(table, DECIDED)), answer(DECIDED, compare(table))])

    return first, second, third, fourth


def find_spans(blocks: DataFrame, buckets: int, regions, decide, extract, compare) -> DataFrame:
    """(block, ..., row, first, last): packed window starts to mark in every document.

    ``regions(block, table)`` -> (decided, open) entries of a block;
    ``decide(entries, crowded names)`` -> (decided, open, crowded) entries of a bucket, the
    latter two by block;
    ``extract(block, table, open, crowded)`` -> decided entries, and packed rows for
    ``compare``, sent by bucket;
    ``compare(table)`` -> decided entries.
    """
    first, second, third, fourth = steps(buckets, regions, decide, extract, compare)
    sent = map_groups(blocks, ["block"], first, SENT)
    answered = to_blocks(map_groups(sent, ["bucket"], second, SENT))
    compared = map_cogroups(blocks, answered, ["block"], third, SENT)
    return to_blocks(map_groups(compared, ["bucket"], fourth, SENT))


def marked_starts(answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of everything decided for one block."""
    return unpack(answers["row"], np.int32), unpack(answers["first"], np.int32), unpack(answers["last"], np.int32)
