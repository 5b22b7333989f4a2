"""Token ids as binary files of shuffled bit or byte planes.

A file holds the ids of some documents, one after the other. Blocks of ``BLOCK_IDS`` ids
are transposed, so that all lowest bytes (or bits) of a block come first, then all second
lowest ones and so on; each plane is compressed by itself, and a plane of zeros takes no
space. Ids below 2^16 thus cost nothing for their two upper bytes.

    file    = chunk* footer
    chunk   = planes, lowest first, each a zstandard frame or empty; line feed
    footer  = zstandard frame of the index; its length (u32); MAGIC; line feed
    index   = head (struct _HEAD); chunk starts (u64, one more than chunks);
              plane sizes (u32, chunks x planes); crc32 of each block's ids (u32);
              first id of each document in the file (u64, one more than documents);
              document keys (i64); whether a key is null (u8)

All numbers are little-endian. The index lets a reader open any range of ids or any
document by decoding only the blocks it touches (``TokenFile``).

Documents are dealt to files by ranges of their key, so files in the order of their shard
numbers hold the documents in ascending key order. Spark's text sink writes the records:
it works on any store that Spark writes to, and commits a file only when its task is done,
so a task that runs again after a lost executor leaves no trace.

Defined results: null and empty texts have the end id only (or no ids where there is
none); rows with a null key come first, rows of one key in the order of their texts'
hashes, and equal rows next to each other. Texts are encoded whole, whatever their length. An empty
table makes files without documents. Other columns are not looked at.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.joins import lookup_join
from ..operators.staging import hadoop_path, stage_lookup
from .byte_bpe import byte_slices, collector_paused
from .shipping import map_batches
from .tables import with_fields

BLOCK_IDS = 1 << 16
FILE_TEXT_BYTES = 32 << 20
LAYOUTS = ("byte", "bit")
LEVEL = 3
MAGIC = b"PLANES01"
# version, shard, layout, ids a block, documents, ids, chunks
_HEAD = struct.Struct("<IIIIQQQ")
_TAIL = struct.Struct("<I8sc")

# Characters that are surely no white space to any regular expression library.
_PLAIN = "!-~À-ɏ"
_ODD_SPACE = re.compile(rf" (?![{_PLAIN}])")
_SPLIT = re.compile(rf" (?=[{_PLAIN}])")
# Parts that are sure to be kept apart by a line feed between them; several such parts make another one.
_PLAIN_LINES = re.compile(rf" ?[{_PLAIN}]+(?:\n ?[{_PLAIN}]+)*").fullmatch
_TAILS = ".,;:!?"
CACHED_CHARS = 6 << 20
CHUNK_PARTS = 256


def to_planes(ids: np.ndarray, layout: str) -> list[bytes]:
    """The planes of a block of ids, lowest first; the last bit plane byte is filled up with zeros."""
    by_byte = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if layout == "byte":
        return [plane.tobytes() for plane in by_byte]
    shifts = np.arange(8, dtype=np.uint8)[:, None]
    return [bits.tobytes() for plane in by_byte for bits in np.packbits((plane >> shifts) & 1, axis=1)]


def from_planes(planes: list[bytes], count: int, layout: str) -> np.ndarray:
    """The ``count`` ids of a block; an empty plane is one of zeros."""
    by_byte = np.zeros((4, count), np.uint8)
    for i, plane in enumerate(planes):
        if not plane:
            continue
        values = np.frombuffer(plane, np.uint8)
        if layout == "byte":
            by_byte[i] = values
        else:
            by_byte[i >> 3] |= np.unpackbits(values, count=count) << np.uint8(i & 7)
    return np.ascontiguousarray(by_byte.T).view("<u4").ravel()


class FileWriter:
    """Makes the records of one file; the sink puts a line feed behind each."""

    def __init__(self, shard: int, layout: str = "byte", block_ids: int = BLOCK_IDS, level: int = LEVEL):
        if layout not in LAYOUTS:
            raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
        self.shard, self.layout, self.block_ids = shard, layout, block_ids
        self._compress = zstandard.ZstdCompressor(level=level).compress
        self._waiting = bytearray()
        self._starts, self._sizes, self._checks = array("Q", [0]), array("I"), array("I")
        self._firsts, self._keys, self._no_key = array("Q", [0]), array("q"), bytearray()

    def add(self, key: int | None, ids: bytes) -> Iterator[bytes]:
        """Append a document; yields the chunks that are full."""
        self._keys.append(0 if key is None else key)
        self._no_key.append(key is None)
        self._firsts.append(self._firsts[-1] + len(ids) // 4)
        self._waiting += ids
        size, done = self.block_ids * 4, 0
        while len(self._waiting) - done >= size:
            yield self._chunk(bytes(self._waiting[done : done + size]))
            done += size
        del self._waiting[:done]

    def _chunk(self, ids: bytes) -> bytes:
        planes = to_planes(np.frombuffer(ids, "<u4"), self.layout)
        packed = [self._compress(plane) if any(plane) else b"" for plane in planes]
        self._sizes.extend(map(len, packed))
        self._checks.append(zlib.crc32(ids))
        self._starts.append(self._starts[-1] + sum(map(len, packed)) + 1)
        return b"".join(packed)

    def finish(self) -> Iterator[bytes]:
        """The last chunk and the footer."""
        if self._waiting:
            yield self._chunk(bytes(self._waiting))
        layout = LAYOUTS.index(self.layout)
        head = _HEAD.pack(1, self.shard, layout, self.block_ids, len(self._keys), self._firsts[-1], len(self._checks))
        arrays = (self._starts, self._sizes, self._checks, self._firsts, self._keys)
        index = self._compress(head + b"".join(a.tobytes() for a in arrays) + self._no_key)
        yield index + _TAIL.pack(len(index), MAGIC, b"\n")[:-1]


class TokenFile:
    """Reads a file from its bytes, or from a memory map of it."""

    def __init__(self, data):
        self._data = memoryview(data)
        length, magic, _ = _TAIL.unpack(self._data[-_TAIL.size :])
        if magic != MAGIC:
            raise ValueError("not a file of token planes")
        self._decompress = zstandard.ZstdDecompressor().decompress
        index = self._decompress(self._data[-_TAIL.size - length : -_TAIL.size])
        _, self.shard, layout, self.block_ids, self.documents, self.size, chunks = _HEAD.unpack_from(index)
        self.layout = LAYOUTS[layout]
        self._planes = 4 if self.layout == "byte" else 32
        at = _HEAD.size

        def read(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(index, dtype, count, at)
            at += found.nbytes
            return found

        self._starts = read("<u8", chunks + 1)
        self._sizes = read("<u4", chunks * self._planes).reshape(chunks, self._planes)
        self._checks = read("<u4", chunks)
        self.firsts = read("<u8", self.documents + 1).astype(np.int64)
        self.keys = read("<i8", self.documents)
        self.no_key = read("u1", self.documents).astype(bool)
        self._last = (-1, np.zeros(0, "<u4"))

    def block(self, chunk: int) -> np.ndarray:
        """The ids of one block, checked against their crc32; the last one decoded is kept."""
        if self._last[0] != chunk:
            count = min(self.block_ids, self.size - chunk * self.block_ids)
            ends = int(self._starts[chunk]) + np.cumsum(self._sizes[chunk], dtype=np.int64)
            pieces = [self._data[end - size : end] for end, size in zip(ends.tolist(), self._sizes[chunk].tolist())]
            ids = from_planes([self._decompress(piece) if len(piece) else b"" for piece in pieces], count, self.layout)
            if zlib.crc32(ids) != self._checks[chunk]:
                raise ValueError(f"block {chunk} of shard {self.shard} is damaged")
            self._last = (chunk, ids)
        return self._last[1]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids at [start, stop) of the file."""
        size, found = self.block_ids, []
        while start < stop:
            chunk, inside = divmod(start, size)
            found.append(self.block(chunk)[inside : inside + stop - start])
            start += len(found[-1])
        return np.concatenate(found) if found else np.zeros(0, "<u4")

    def document(self, nth: int) -> np.ndarray:
        return self.ids(int(self.firsts[nth]), int(self.firsts[nth + 1]))


class StretchEncoder:
    """Encodes texts with the tokenizers library, each different stretch between spaces once.

    With a byte-level split, a space before a character that is no white space always starts a new
    piece, and so does a line feed between two such characters. So stretches between such spaces are encoded
    by themselves and their ids put behind each other. The library gets many at once, separated by line feeds.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # Whether the tokenizer splits in this way; any other one encodes texts as a whole.
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str("a  b 'c\n d\ne") if self.tokenizer.pre_tokenizer else []
        spelled = ["a", "Ġ", "Ġb", "Ġ'", "c", "Ċ", "Ġd", "Ċ", "e"]
        self._splits = [piece for piece, _ in split] == spelled and not self.tokenizer.normalizer
        self._line_feed = self.tokenizer.token_to_id("Ċ")
        self._tails = dict(zip(_TAILS, self._alone(list(_TAILS))))
        # Ids of stretches behind a space (kept without it) and of others; the last generation of the former.
        self._spaced: dict[str, bytes] = {}
        self._others: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._held = 0

    def _alone(self, texts: list[str]) -> list[bytes]:
        return [array("I", found.ids).tobytes() for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, chunks: list[tuple[list[str], str]]) -> list[bytes]:
        """Ids of the parts of all chunks, each given with its parts put on lines."""
        found = []
        for (parts, _), ids in zip(chunks, self._alone([lines for _, lines in chunks])):
            cuts = np.flatnonzero(np.frombuffer(ids, "<u4") == self._line_feed)
            if len(cuts) >= len(parts):  # some parts hold line feeds themselves
                inside = np.cumsum([part.count("\n") for part in parts]) + np.arange(len(parts))
                if len(cuts) != inside[-1]:
                    raise ValueError("the tokenizer does not keep lines apart")
                cuts = cuts[inside[:-1]]  # the line feed behind each part
            elif len(cuts) < len(parts) - 1:
                raise ValueError("the tokenizer does not keep lines apart")
            ends = (cuts * 4).tolist()
            found += [ids[a:b] for a, b in zip([0, *[end + 4 for end in ends]], [*ends, len(ids)])]
        return found

    def _learn(self, parts: list[str], space: str, known: dict[str, bytes]) -> None:
        """Put the ids of every part, with ``space`` before it, with the known ones."""
        chunks, odd, between = [], [], "\n" + space
        for at in range(0, len(parts), CHUNK_PARTS):
            chunk = parts[at : at + CHUNK_PARTS]
            lines = space + between.join(chunk)
            if not _PLAIN_LINES(lines):
                plain = [part for part in chunk if _PLAIN_LINES(space + part)]
                odd += [part for part in chunk if not _PLAIN_LINES(space + part)]
                chunk, lines = plain, space + between.join(plain)
            if chunk:
                chunks.append((chunk, lines))
        known.update(zip([part for chunk, _ in chunks for part in chunk], self._together(chunks)))
        known.update(zip(odd, self._alone([space + part for part in odd])))
        self._held += sum(map(len, parts)) + len(space) * len(parts)

    def _make_room(self) -> None:
        if self._held > CACHED_CHARS:
            self._old, self._spaced, self._others, self._held = self._spaced, {}, {}, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as unsigned 32-bit integers."""
        if not self._splits:
            return self._alone(texts)
        with collector_paused():
            return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[bytes]:
        self._make_room()
        known, rows, missing = self._spaced.get, [], set()
        for text in texts:
            words = text.split(" ") if _ODD_SPACE.search(text) is None else _SPLIT.split(text)
            ids = list(map(known, words))
            ids[0] = None  # the first one has no space before it
            gaps = [i for i, own in enumerate(ids) if own is None][1:]
            missing.update([words[i] for i in gaps])
            rows.append((words, ids, gaps))
        spaced, old, tails = self._spaced, self._old, self._tails
        again = missing & old.keys()
        spaced.update(zip(again, map(old.__getitem__, again)))
        missing -= again
        # A run of letters is a piece by itself, so punctuation behind it is put behind its ids.
        ended = [word for word in missing if not word.isalpha() and word[-1:] in tails and word[:-1].isalpha()]
        missing.difference_update(ended)
        stems = [word[:-1] for word in ended]
        missing.update([stem for stem in stems if stem not in spaced])
        self._learn(list(missing), " ", spaced)
        others = self._others
        self._learn(list({words[0] for words, _, _ in rows}.difference(others)), "", others)
        for word, stem in zip(ended, stems):
            spaced[word] = spaced[stem] + tails[word[-1]]
        # What _learn keeps it counts itself.
        self._held += sum(map(len, again)) + sum(map(len, ended)) + len(again) + len(ended)
        for words, ids, gaps in rows:
            ids[0] = others[words[0]]
            for i in gaps:
                ids[i] = spaced[words[i]]
        return [b"".join(ids) for _, ids, _ in rows]


_encoders: dict[str, StretchEncoder] = {}


def _encoder(path: str) -> StretchEncoder:
    if path not in _encoders:
        _encoders[path] = StretchEncoder(path)
    return _encoders[path]


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int | None = None,
    layout: str = "byte",
    block_ids: int = BLOCK_IDS,
    file_text_bytes: int = FILE_TEXT_BYTES,
    text: str = "text",
    key: str = "doc_id",
) -> None:
    """Encode every text, append ``end_id`` and write the files to ``folder`` in key order.

    ``tokenizer_path`` is read by the executors; it belongs to an installed package. A file
    holds about ``file_text_bytes`` of text.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("double"))).first()[0] or 0.0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -int(-total // file_text_bytes))
    # Rows of one key are spread by their texts, and equal rows by what the scan says of their place.
    named = rows.select("*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("place"))
    dealt = named.repartitionByRange(files, "key", "h", "place").sortWithinPartitions("key", "h", "place")
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        writer = FileWriter(TaskContext.get().partitionId(), layout, block_ids)

        def as_batch(records: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

        for batch in batches:
            for part in byte_slices(batch, "text"):
                keys, texts = part.column("key").to_pylist(), part.column("text").to_pylist()
                records = [r for k, ids in zip(keys, encoder.encode(texts)) for r in writer.add(k, ids + end)]
                if records:
                    yield as_batch(records)
        yield as_batch(list(writer.finish()))

    records = map_batches(dealt.select("key", "text"), run, "record binary")
    # A cast to string keeps the bytes as they are.
    records.select(F.col("record").cast("string")).write.text(folder, compression="none")


def _read(spark: SparkSession, folder: str, run, schema) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")

    def over_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                if len(content.as_buffer()):
                    yield from run(TokenFile(content.as_buffer()))

    return map_batches(files, over_files, schema)


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, documents, shard_tokens, before) of every file; ``before``: ids in the files before it.

    One row per file, from the footers; staged.
    """

    def run(file: TokenFile) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pylist([{"shard": file.shard, "documents": file.documents, "shard_tokens": file.size}])

    found = _read(spark, folder, run, "shard bigint, documents bigint, shard_tokens bigint")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return stage_lookup(found.withColumn("before", F.coalesce(F.sum("shard_tokens").over(earlier), F.lit(0))))


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_key, start, n_tokens, ids_crc32, token_ids) of every document of the files in ``folder``.

    ``start``: ids of all documents before it; ``token_ids``: binary, unsigned 32-bit
    integers, left out where ``with_ids`` is false.
    """
    ddl = "shard bigint, doc_key bigint, first bigint, n_tokens bigint, ids_crc32 bigint"
    schema = with_fields(spark.createDataFrame([], ddl).schema, "token_ids binary") if with_ids else ddl

    def run(file: TokenFile) -> Iterator[pa.RecordBatch]:
        step = 4096
        for at in range(0, file.documents, step):
            end = min(at + step, file.documents)
            ids = [file.document(i).tobytes() for i in range(at, end)]
            columns = [
                pa.array(np.full(end - at, file.shard)),
                pa.array(file.keys[at:end], mask=file.no_key[at:end]),
                pa.array(file.firsts[at:end]),
                pa.array(np.diff(file.firsts[at : end + 1])),
                pa.array([zlib.crc32(i) for i in ids], pa.int64()),
            ]
            names = ["shard", "doc_key", "first", "n_tokens", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "token_ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    found = _read(spark, folder, run, schema)
    placed = lookup_join(found, shards(spark, folder).select("shard", "before"), "shard", ["doc_key", "first"])
    rest = ["n_tokens", "ids_crc32", *(["token_ids"] if with_ids else [])]
    return placed.select("doc_key", (F.col("before") + F.col("first")).alias("start"), *rest)


def read_range(spark: SparkSession, folder: str, start: int, stop: int) -> np.ndarray:
    """The ids at [start, stop) of all files together, read through the chunk index.

    For a reader of training batches: only the files that hold part of the range are opened.
    """
    wanted = shards(spark, folder).where((F.col("before") < stop) & (F.col("before") + F.col("shard_tokens") > start))
    before = {row.shard: row.before for row in wanted.collect()}  # the files that the range touches
    found = []
    for shard in sorted(before):
        fs, pattern = hadoop_path(spark, f"{folder}/part-{shard:05d}-*")
        name = fs.globStatus(pattern)[0].getPath().toString()
        content = spark.read.format("binaryFile").load(name).select("content").first()[0]
        file, base = TokenFile(content), before[shard]
        found.append(file.ids(max(start - base, 0), min(stop - base, file.size)))
    return np.concatenate(found) if found else np.zeros(0, "<u4")
