"""Phrase collocations: phrases of two to five words that occur more often than their parts suggest.

Phrases are counted in rounds, by the words of the pieces between punctuation: single words
first, then pairs of frequent words, then longer phrases all of whose pairs are frequent. A phrase is
never more frequent than its parts, so nothing that reaches the least frequency is left out, and
every count covers the whole corpus.

Counting uses a HAT-trie per language and length: a trie over word ids at the top whose nodes start
as hash containers of suffixes; a container that grows beyond ``BURST`` bursts into one
container per next word. When a task's tries hold ``MOST_ENTRIES`` entries, whole subtrees, the
largest first, are spilled as sorted runs: one row per prefix partition, holding phrases with
counts. A prefix partition (a hash of the first three words at most) merges its runs. Texts are never
shuffled, and a phrase that a third of all documents share is one entry in each run.

Which words and pairs are frequent is told to the tasks by a Bloom filter of at most ``MOST_BITS``
bits, whatever their number. Its mistakes only let more phrases be counted; the counts themselves
are those of the spelled-out phrases.

Defined results: null and empty texts have no words; a null language is ``und``. Repeated rows
count each time, and very long texts are read whole. Phrases never cross punctuation, line ends or
documents. An empty table has no phrases. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.staging import stage
from .blocks import bucket_of, unpack
from .byte_bpe import _in_slices
from .hashing import combine, mix
from .shipping import map_batches, map_groups

LEAST = 100
MOST_WORDS = 5
KEEP_PERCENT = 100
FIRST = 2000
NO_LANGUAGE = "und"

BURST = 4096
MOST_ENTRIES = 300_000
MOST_NUMBERED = 500_000
SLICE_CHARS = 1 << 20
PARTITION_BYTES = 8 << 20
BITS_EACH = 16
MOST_BITS = 1 << 27

_BREAK = b"."
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_WORDS = bytes(0x2E if b in _ENDS else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

_RUN = "lang string, part int, phrases binary, counts binary"
_RUN_ARROW = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("phrases", pa.binary()), ("counts", pa.binary())])
_COUNTED = "lang string, phrase binary, n_words int, f bigint"
_COUNTED_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("n_words", pa.int32()), ("f", pa.int64())])


def words_of(texts: list[bytes]) -> list[bytes]:
    """Lower-case words of all texts; a single full stop ends each piece."""
    return b"\n".join(texts).translate(_TO_WORDS).replace(_BREAK, b" . ").split()


def seed_of(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


class Filter:
    """Bloom filter over 64-bit names; says yes to all it was made of."""

    PROBES = 3

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def places(cls, names: np.ndarray, bits: int) -> np.ndarray:
        probes = np.arange(1, cls.PROBES + 1, dtype=np.uint64)[:, None]
        return mix(names[None, :] + probes) & np.uint64(bits - 1)

    def may_hold(self, names: np.ndarray) -> np.ndarray:
        places = self.places(names, len(self.slots) * 64)
        hit = (self.slots[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))) & np.uint64(1)
        return hit.all(axis=0)


class HatTrie:
    """Counts of phrases of one length, as word ids: first word, then containers of suffixes."""

    def __init__(self, length: int, burst: int = BURST):
        self.length, self.burst, self.size = length, burst, 0
        # A node is a container, or containers by the next word where one has burst.
        self.nodes: dict[int, Counter | dict[bytes, Counter]] = {}

    def add(self, ids: np.ndarray, starts: np.ndarray) -> None:
        """Count the phrases that start at ``starts``."""
        if not len(starts):
            return
        starts = starts[np.lexsort((ids[starts + 1], ids[starts]))]
        rest = self.length - 1
        suffixes = np.lib.stride_tricks.sliding_window_view(ids.astype(">u4"), rest)[starts + 1]
        keys = np.ascontiguousarray(suffixes).view(f"V{4 * rest}").ravel().tolist()
        first = ids[starts]
        bounds = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
        for word, a, b in zip(first[bounds].tolist(), bounds.tolist(), [*bounds[1:].tolist(), len(keys)]):
            self._count(word, keys[a:b])

    def _count(self, word: int, keys: list[bytes]) -> None:
        node = self.nodes.get(word)
        if node is None:
            node = self.nodes[word] = Counter()
        if isinstance(node, Counter):
            before = len(node)
            node.update(keys)
            self.size += len(node) - before
            if len(node) > self.burst and self.length > 2:
                self.nodes[word] = children = {}
                for key, count in node.items():
                    children.setdefault(key[:4], Counter())[key[4:]] = count
            return
        for second, group in groupby(keys, lambda key: key[:4]):
            child = node.setdefault(second, Counter())
            before = len(child)
            child.update([key[4:] for key in group])
            self.size += len(child) - before

    @staticmethod
    def _entries(node: Counter | dict) -> int:
        return len(node) if isinstance(node, Counter) else sum(map(len, node.values()))

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Take out whole subtrees, the largest first, until at most ``keep`` entries are left.

        Returns phrases as rows of word ids, and their counts.
        """
        words, parts, counts = [], [], []
        sizes = {word: self._entries(node) for word, node in self.nodes.items()}
        for word in sorted(sizes, key=lambda w: -sizes[w]) if keep else list(sizes):
            if self.size <= keep:
                break
            node = self.nodes.pop(word)
            self.size -= sizes[word]
            words.append((word, sizes[word]))
            for second, container in [(b"", node)] if isinstance(node, Counter) else node.items():
                parts.append(b"".join(second + key for key in container) if second else b"".join(container))
                counts.extend(container.values())
        suffixes = np.frombuffer(b"".join(parts), ">u4").reshape(-1, self.length - 1).astype(np.int64)
        first = np.repeat(*np.array(words, np.int64).reshape(-1, 2).T)
        return np.column_stack([first, suffixes]), np.array(counts, np.int64)


class _Language:
    """What a task has counted of one language."""

    def __init__(self, lang: str, lengths: range, words: Filter | None, pairs: Filter | None):
        self.lang, self.lengths, self._frequent, self._pairs = lang, lengths, words, pairs
        self._seed = seed_of(lang)
        self.total, self.single = 0, Counter()
        self.start_numbering()

    def start_numbering(self) -> None:
        self.tries = {length: HatTrie(length) for length in self.lengths if length > 1}
        # Ids of words that may be frequent, 0 of any other; words and their names by id.
        self.numbered, self.words, self.names = {_BREAK: 0}, [_BREAK], np.zeros(1, np.uint64)

    @property
    def size(self) -> int:
        return len(self.single) + sum(trie.size for trie in self.tries.values())

    def _number(self, new: list[bytes]) -> None:
        names = np.array([xxhash.xxh64_intdigest(word, self._seed) for word in new], np.uint64)
        may_be = np.ones(len(new), bool) if self._frequent is None else self._frequent.may_hold(names)
        self.numbered.update(dict.fromkeys(new, 0))
        kept = [new[i] for i in np.flatnonzero(may_be)]
        self.numbered.update(zip(kept, range(len(self.words), len(self.words) + len(kept))))
        self.words += kept
        self.names = np.concatenate([self.names, names[may_be]])

    def add(self, texts: list[bytes]) -> None:
        words = words_of(texts)
        if 1 in self.lengths:
            self.single.update(words)
            self.total += len(words) - self.single.pop(_BREAK, 0)
            return
        if new := list(set(words).difference(self.numbered)):
            self._number(new)
        ids = np.fromiter(map(self.numbered.__getitem__, words), np.int64, len(words))
        known = ids > 0
        # Whether the pair that starts at a place may be frequent.
        pair = np.flatnonzero(known[:-1] & known[1:]) if len(ids) else np.zeros(0, np.int64)
        if self._pairs is not None and len(pair):
            pair = pair[self._pairs.may_hold(combine(self.names[ids[pair]], self.names[ids[pair + 1]]))]
        linked = np.zeros(len(ids) + 1, bool)
        linked[pair] = True
        whole, starts = linked, pair
        for length in range(2, self.lengths.stop):
            if length > 2:
                # The first length - 1 words start here, and the last two of them in front of one more.
                starts = starts[whole[starts] & linked[np.minimum(starts + length - 2, len(ids))]]
            if length in self.tries:
                self.tries[length].add(ids, starts)

    def runs(self, parts: int, keep: int) -> Iterator[pa.RecordBatch]:
        """Spill down to about ``keep`` entries: one row per prefix partition and length."""
        if self.single:
            words = list(self.single)
            names = np.array([xxhash.xxh64_intdigest(word, self._seed) for word in words], np.uint64)
            counts = np.fromiter(self.single.values(), np.int64, len(words))
            yield self._run([pa.array(words, pa.binary())], names, counts, parts)
            self.single = Counter()
        if self.total:
            # The empty phrase carries the number of words.
            yield self._run([pa.array([b""], pa.binary())], np.zeros(1, np.uint64), np.array([self.total]), parts)
            self.total = 0
        total = max(self.size, 1)
        for trie in self.tries.values():
            ids, counts = trie.spill(keep * trie.size // total)
            if len(counts):
                spelled = pa.array(self.words, pa.binary())
                prefix = combine(self.names[ids[:, 0]], self.names[ids[:, 1]])
                if trie.length > 2:
                    prefix = combine(prefix, self.names[ids[:, 2]])
                yield self._run([spelled.take(pa.array(column)) for column in ids.T], prefix, counts, parts)

    def _run(self, columns: list[pa.Array], prefix: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
        phrases = pc.binary_join_element_wise(*columns, b" ") if len(columns) > 1 else columns[0]
        part = bucket_of(prefix, parts)
        order = np.array(pc.sort_indices(pa.table([part, phrases], ["part", "phrase"]), [("part", "ascending"), ("phrase", "ascending")]))
        lines = pc.binary_join_element_wise(phrases.take(pa.array(order)), b"", b"\n")
        part, counts = part[order], counts[order]
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        bounds = np.r_[first, len(part)]
        offsets = np.frombuffer(lines.buffers()[1], np.int32, len(lines) + 1, lines.offset * 4)
        text = pa.py_buffer(np.ascontiguousarray(offsets[bounds]))
        packed = [
            pa.array([self.lang] * len(first), pa.string()),
            pa.array(part[first], pa.int32()),
            pa.Array.from_buffers(pa.binary(), len(first), [None, text, lines.buffers()[2]]),
            pa.array([counts[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(packed, schema=_RUN_ARROW)


def _merge(table: pa.Table) -> pa.Table:
    """Runs of one language and prefix partition: counts of each phrase."""
    lines = b"".join(table["phrases"].to_pylist())
    ends = np.flatnonzero(np.frombuffer(lines, np.uint8) == 10).astype(np.int64) + 1
    offsets = pa.py_buffer(np.r_[0, ends])
    phrases = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, offsets, pa.py_buffer(lines)])
    counted = pa.table({"phrase": phrases, "f": unpack(table["counts"], np.int64)})
    found = counted.group_by("phrase", use_threads=False).aggregate([("f", "sum")])  # Spark runs a task per core
    return pa.table({"phrase": pc.binary_slice(found["phrase"].cast(pa.binary()), 0, -1), "f": found["f_sum"]})


def count(
    docs: DataFrame,
    lengths: range,
    least: int,
    words: Filter | None = None,
    pairs: Filter | None = None,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """(lang, phrase, n_words, f) of the phrases of the given lengths that occur ``least`` times; staged.

    With single words comes the empty phrase, which stands for all words of the language.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(F.col(text)).cast("double"))).first()[0] or 0.0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -int(-total // PARTITION_BYTES))
    chosen = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages: dict[str, _Language] = {}

        def spilled(keep: int = 0) -> Iterator[pa.RecordBatch]:
            total = max(1, sum(language.size for language in languages.values()))
            for language in languages.values():
                yield from language.runs(parts, keep * language.size // total)

        for batch in batches:
            for part, texts in _in_slices(batch, batch.column("text").to_pylist(), SLICE_CHARS):
                by_language: dict[str, list[bytes]] = {}
                for own, text in zip(part.column("lang").to_pylist(), texts):
                    by_language.setdefault(own, []).append(text.encode())
                for own, theirs in by_language.items():
                    if own not in languages:
                        languages[own] = _Language(own, lengths, words, pairs)
                    languages[own].add(theirs)
                if sum(language.size for language in languages.values()) > MOST_ENTRIES:
                    yield from spilled(MOST_ENTRIES // 2)
                if sum(len(language.numbered) for language in languages.values()) > MOST_NUMBERED:
                    yield from spilled()
                    for language in languages.values():
                        language.start_numbering()
        yield from spilled()

    def merge(key, table):
        found = _merge(table)
        found = found.filter(pc.or_(pc.greater_equal(found["f"], least), pc.equal(found["phrase"], pa.scalar(b"", pa.binary()))))
        n_words = pc.add(pc.count_substring(found["phrase"], " "), pc.greater(pc.binary_length(found["phrase"]), 0).cast(pa.int32()))
        return pa.table([pa.array([key[0].as_py()] * len(found), pa.string()), found["phrase"], n_words, found["f"]], schema=_COUNTED_ARROW)

    runs = map_batches(chosen, run, _RUN)
    counted = map_groups(runs, ["lang", "part"], merge, _COUNTED)
    return stage(counted.withColumn("phrase", F.col("phrase").cast("string")))


def names_of(langs: list[str], phrases: list[str]) -> np.ndarray:
    """Names of words, or of pairs of words, as tasks compute them."""
    seeds = {lang: seed_of(lang) for lang in set(langs)}
    split = [phrase.encode().split(b" ") for phrase in phrases]
    names = [[xxhash.xxh64_intdigest(word, seeds[lang]) for word in words] for lang, words in zip(langs, split)]
    columns = np.array(names, np.uint64).reshape(len(names), -1).T
    return columns[0] if len(columns) == 1 else combine(columns[0], columns[1])


def filter_of(counted: DataFrame) -> Filter:
    """Filter of the (lang, phrase) of a staged table; at most ``MOST_BITS`` bits go through the driver."""
    some = counted.where("n_words > 0").select("lang", "phrase")
    bits = 1 << 12
    while bits < min(BITS_EACH * some.count(), MOST_BITS):
        bits <<= 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places = Filter.places(names_of(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()), bits).ravel()
            slots, at = np.unique(places >> np.uint64(6), return_inverse=True)
            marks = np.zeros(len(slots), np.uint64)
            np.bitwise_or.at(marks, at, np.uint64(1) << (places & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), pa.array(marks.view(np.int64))], ["slot", "marks"])

    found = map_batches(some, run, "slot bigint, marks bigint").groupBy("slot").agg(F.bit_or("marks").alias("marks")).toArrow()
    slots = np.zeros(bits // 64, np.uint64)
    slots[found["slot"].to_numpy()] = found["marks"].to_numpy().view(np.uint64)
    return Filter(slots)


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """(lang, phrase, n_words, f) of all phrases of up to ``most_words`` words that occur ``least`` times."""
    columns = {"text": text, "lang": lang}
    words = count(docs, range(1, 2), least, **columns)
    known = filter_of(words)
    pairs = count(docs, range(2, 3), least, known, **columns)
    found = words.unionByName(pairs)
    if most_words > 2:
        found = found.unionByName(count(docs, range(3, most_words + 1), least, known, filter_of(pairs), **columns))
    return found


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates, by their lowest-scoring cut."""
    words = F.split("phrase", " ")
    candidates = frequent.where("n_words > 1").withColumnRenamed("f", "a")
    cuts = candidates.select(
        "lang", "phrase", "a", words.alias("words"), "n_words", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("n_words") - F.col("k")), " ").alias("rest"),
    )
    parts = frequent.where("n_words > 0")
    sizes = frequent.where("n_words = 0").select("lang", F.col("f").alias("n"))
    cuts = (
        cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
        .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .join(sizes, "lang")
    )
    # Decimals of 38 digits hold the products.
    score = F.expr(
        "(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0)))"
        " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    )
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def without_contained(candidates: DataFrame, frequent: DataFrame, keep_percent: int = KEEP_PERCENT) -> DataFrame:
    """Candidates that no longer frequent phrase holds in ``keep_percent`` of their occurrences or more."""
    longer = frequent.where("n_words > 2").select("lang", "f", F.split("phrase", " ").alias("words"), "n_words")
    sizes = longer.select("*", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("size"))
    places = sizes.select("*", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)).alias("start"))
    inner = places.select("lang", F.array_join(F.slice("words", F.col("start"), F.col("size")), " ").alias("phrase"), "f")
    inner = inner.groupBy("lang", "phrase").agg(F.max("f").alias("inside"))
    joined = candidates.join(inner, ["lang", "phrase"], "left")
    return joined.where(F.col("inside").isNull() | (100 * F.col("inside") < keep_percent * F.col("a"))).drop("inside")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    most_words: int = MOST_WORDS,
    keep_percent: int = KEEP_PERCENT,
    first: int = FIRST,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``first`` collocations."""
    frequent = frequent_phrases(docs, least, most_words, text, lang)
    candidates = without_contained(scored(frequent), frequent, keep_percent)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        candidates.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= first)
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
