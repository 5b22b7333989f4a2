"""Byte-level BPE encoding and decoding by dynamic programming over byte prefixes.

For every prefix of a piece the table stores one token: the last one of that prefix's
encoding. It is the only token t that ends the prefix, for which the prefix before it
has a last token p, and whose pair (p, t) the merges leave as it is. Encodings are
read off backwards. Because an entry looks back at most one token length,

* appending bytes only adds entries, and
* after an edit, entries are recomputed until one longest-token length of them agrees
  with the old ones again; everything behind is kept.

Defined results: null and empty texts have no tokens and decode to no bytes; every
row is encoded by itself, so ties and repeated rows do not matter; other columns of
the table, whatever their names, are not looked at.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .shipping import map_batches
from .tables import free_name, with_fields

SLICE_BYTES = 4 << 20
CACHED_BYTES = 20 << 20  # a generation of a cache, with what Python adds to each entry
ENTRY_BYTES = 220
CACHED_PAIRS = 300_000
_NONE = 1 << 60
_TAILS = frozenset(".,;:!?")

# With this pattern a single space between two characters that are no white space always
# starts a new match, and a run of letters is one. Other patterns are applied as they are.
SPACE_LED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Printable ASCII and Latin letters, none of them white space.
_PLAIN = "!-~À-ɏ"
_ODD_SPACE = regex.compile(rf"(?<![{_PLAIN}]) | (?![{_PLAIN}])")


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one "base64-token rank" line per token."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PrefixEncoder:
    """Encodes single pieces; holds the ranks and the pairs found valid or not."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._sizes = {rank: len(token) for token, rank in ranks.items()}
        # For every token, those before it that are known to stay or not; the filled ones of these, and their pairs.
        self._pairs: dict[int, dict[int, bool]] = {rank: {} for rank in ranks.values()}
        self._filled: list[dict[int, bool]] = []
        self._known = 0
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._edges: tuple[dict[int, list[int]], dict[int, list[int]]] = ({}, {})
        self._spelled: tuple[dict[int, list[bytes]], dict[int, list[bytes]]] = ({}, {})
        self._endings = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._endings.add_word(token.decode("latin-1"), (rank, len(token), self._pairs[rank]))
        self._endings.make_automaton()

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge is ``token``; None for a byte or a token no merge makes."""
        if token not in self._halves:
            data = self.tokens[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                best, at = min((self.ranks.get(parts[i] + parts[i + 1], _NONE), i) for i in range(len(parts) - 1))
                if best == _NONE:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = tuple(self.ranks[part] for part in parts) if len(parts) == 2 else None
        return self._halves[token]

    def _edge(self, token: int, side: int) -> list[int]:
        """The tokens that stand at one end of ``token`` while it grows, from a byte to itself."""
        known = self._edges[side].get(token)
        if known is None:
            found = [token]
            while (halves := self.halves(found[-1])) is not None:
                found.append(halves[side])
            known = self._edges[side][token] = found[::-1]
        return known

    def _spell(self, token: int, side: int) -> list[bytes]:
        """The bytes of ``_edge``'s tokens."""
        known = self._spelled[side].get(token)
        if known is None:
            known = self._spelled[side][token] = [self.tokens[part] for part in self._edge(token, side)]
        return known

    def made_by_merges(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self.halves(token) is not None

    def _stays(self, before: int, last: int) -> bool:
        if not self.made_by_merges(last) or before >= 0 and not self.made_by_merges(before):
            return False
        if before < 0:
            return True
        left, right = self._edge(before, 1), self._edge(last, 0)
        ends, starts, rank_of = self._spell(before, 1), self._spell(last, 0), self.ranks.get
        lefts, rights = len(left) - 1, len(right) - 1
        i = j = 0
        while True:
            # Merges go by rank, equal ones from left to right: would one join the two first?
            grow_left = left[i + 1] if i < lefts else _NONE
            grow_right = right[j + 1] if j < rights else _NONE
            joined = rank_of(ends[i] + starts[j], _NONE)
            if joined < grow_left and joined <= grow_right and joined != _NONE:
                return False
            if grow_left == grow_right == _NONE:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def stays(self, before: int, last: int) -> bool:
        """Whether the merges leave the pair of tokens as it is. before < 0: none."""
        seen = self._pairs[last]
        known = seen.get(before)
        if known is None:
            if self._known >= CACHED_PAIRS:
                for found in self._filled:
                    found.clear()
                self._filled, self._known = [], 0
            if not seen:
                self._filled.append(seen)
            known = seen[before] = self._stays(before, last)
            self._known += 1
        return known

    def extend(self, lasts: list[int], data: bytes, until: int | None = None) -> None:
        """Add to ``lasts`` the last tokens of the prefixes of ``data`` that it does not have yet."""
        have = len(lasts)
        from_ = max(0, have - self.longest)
        # All tokens that end at a position, the longest first.
        for at, (token, size, seen) in self._endings.iter(data[from_:until].decode("latin-1")):
            end = from_ + at + 1
            if end > have:
                before = lasts[end - size - 1] if end > size else -1
                valid = seen.get(before)
                if self.stays(before, token) if valid is None else valid:
                    lasts.append(token)
                    have = end
        if have < (len(data) if until is None else until):
            raise ValueError("the ranks do not hold every single byte")

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        # As ``extend`` does, with the entry of the empty prefix in front.
        lasts, at_next, stays = [-1], 0, self.stays
        append = lasts.append
        for at, (token, size, seen) in self._endings.iter(piece.decode("latin-1")):
            if at == at_next:
                before = lasts[at + 1 - size]
                valid = seen.get(before)
                if valid is None:
                    valid = stays(before, token)
                if valid:
                    append(token)
                    at_next += 1
        if at_next < len(piece):
            raise ValueError("the ranks do not hold every single byte")
        found, sizes = [], self._sizes
        while at_next:
            token = lasts[at_next]
            found.append(token)
            at_next -= sizes[token]
        found.reverse()
        return found

    def read_back(self, lasts: list[int], at: int) -> list[int]:
        """Tokens of the first ``at`` bytes, from the last one back."""
        found, sizes = [], self._sizes
        while at:
            token = lasts[at - 1]
            found.append(token)
            at -= sizes[token]
        found.reverse()
        return found


class PrefixTable:
    """The last token of every prefix of one piece."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data, self.lasts = encoder, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.encoder.extend(self.lasts, self.data)

    def replace(self, start: int, end: int, by: bytes) -> int:
        """Put ``by`` in place of data[start:end]; returns the number of entries computed."""
        old, tail = self.lasts, len(self.data) - end
        data = self.data[:start] + by + self.data[end:]
        self.data, self.lasts = data, old[:start]
        agreed = 0
        for at in range(start, len(data)):
            self.encoder.extend(self.lasts, data, at + 1)
            from_end = len(data) - at
            same = from_end <= tail and old[len(old) - from_end] == self.lasts[at]
            agreed = agreed + 1 if same else 0
            if agreed >= self.encoder.longest:
                self.lasts += old[len(old) - from_end + 1 :]
                return at + 1 - start
        return len(data) - start

    def ids(self, size: int | None = None) -> list[int]:
        """Tokens of the first ``size`` bytes, by default of all."""
        return self.encoder.read_back(self.lasts, len(self.data) if size is None else size)


def _as_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class _Cached(dict):
    """Two generations: what is used again moves to the young one, the rest is dropped."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.old, self.held = compute, {}, 0

    def __missing__(self, key: str) -> bytes:
        if self.held >= CACHED_BYTES:
            self.old, self.held = dict(self), 0
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        size = len(key) + len(value) + ENTRY_BYTES
        if size < CACHED_BYTES // 64:
            self[key] = value
            self.held += size
        return value


class TextEncoder:
    """Encodes texts: each match of the split pattern is a piece of its own."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoder = PrefixEncoder(ranks)
        self._pieces_of = regex.compile(pattern).findall
        self._space_led = pattern == SPACE_LED
        self._piece = _Cached(self._encode_piece)
        self._stretch = _Cached(self._encode_stretch)
        # The stretches behind a space, kept without it.
        self._spaced = _Cached(self._encode_spaced)

    def _encode_piece(self, piece: str) -> bytes:
        return _as_bytes(self.encoder.encode(piece.encode()))

    def _encode_stretch(self, stretch: str) -> bytes:
        return b"".join([self._piece[piece] for piece in self._pieces_of(stretch)])

    def _encode_spaced(self, word: str) -> bytes:
        if word.isalpha():
            return self._encode_piece(" " + word)
        if word[-1:] in _TAILS and word[:-1].isalpha():
            return self._spaced[word[:-1]] + self._piece[word[-1]]
        return self._encode_stretch(" " + word)

    def _odd_spaces(self, text: str) -> bool:
        """Whether some space may not start a new match."""
        if text.isascii() and text.replace("\n", "").isprintable():
            return "  " in text or "\n " in text or " \n" in text or text[0] == " " or text[-1] == " "
        return _ODD_SPACE.search(text) is not None

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self._space_led or self._odd_spaces(text):
            return b"".join([self._piece[piece] for piece in self._pieces_of(text)])
        first, *others = text.split(" ")
        return self._stretch[first] + b"".join(map(self._spaced.__getitem__, others))


class TokenBytes:
    """The bytes that ids stand for: all a decoder needs."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self._by_id = pa.array(map(self.tokens.get, range(max(self.tokens) + 1)), pa.large_binary())

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_rows(self, ids: list[bytes]) -> pa.Array:
        """The bytes of every row of ids."""
        joined = np.frombuffer(b"".join(ids), "<u4")
        tokens = self._by_id.take(pa.array(joined))
        if tokens.null_count:
            raise KeyError("an id that no token has")
        starts = np.cumsum([0, *(len(row) // 4 for row in ids)])
        _, ends, data = tokens.buffers()
        at = np.frombuffer(ends, np.int64, len(joined) + 1) if len(joined) else np.zeros(1, np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(at[starts]), data]).cast(pa.binary())


_encoders: dict[tuple[str, str], TextEncoder] = {}
_decoders: dict[str, TokenBytes] = {}


def _encoder(path: str, pattern: str) -> TextEncoder:
    key = (path, pattern)
    if key not in _encoders:
        _encoders[key] = TextEncoder(load_ranks(path), pattern)
    return _encoders[key]


def _decoder(path: str, encoder: TextEncoder | None = None) -> TokenBytes:
    if path not in _decoders and encoder is not None:
        _decoders[path] = TokenBytes(encoder.encoder.tokens)
    if path not in _decoders:
        _decoders[path] = TokenBytes({rank: token for token, rank in load_ranks(path).items()})
    return _decoders[path]


@contextmanager
def collector_paused() -> Iterator[None]:
    """Without the cyclic collector, which would walk long lists of words again and again; they hold no cycles."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


def _in_slices(batch: pa.RecordBatch, texts: list, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    start, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield batch.slice(start, at + 1 - start), texts[start : at + 1]
            start, size = at + 1, 0
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def byte_slices(batch: pa.RecordBatch, name: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in parts of about ``most`` bytes of text, so that a caller need not make Python objects of all."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0)
    ends, start = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        stop = min(int(np.searchsorted(ends, done + most)) + 1, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    decoded: str | None = None,
) -> DataFrame:
    """``keep`` columns with ``token_ids`` (binary, little-endian unsigned 32-bit integers).

    ``decoded`` names a further column for the bytes that the ids stand for, decoded in the same pass.
    ``ranks_path`` is read by the executors; it belongs to an installed package.
    """
    kept = docs.select(*keep, docs[text].alias("_text"))
    added = ["token_ids", *([decoded] if decoded else [])]
    schema = with_fields(docs.select(*keep).schema, ", ".join(f"{name} binary" for name in added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        decode_rows = _decoder(ranks_path, encoder).decode_rows
        for batch in batches:
            for part in byte_slices(batch, "_text"):
                with collector_paused():
                    ids = [encoder.encode(t or "") for t in part.column("_text").to_pylist()]
                    columns = [pa.array(ids, pa.binary())]
                    if decoded:
                        columns.append(decode_rows(ids))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], [*keep, *added])

    return map_batches(kept, run, schema)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "token_ids", name: str = "decoded") -> DataFrame:
    """All columns with one more (binary): the bytes that the ids stand for; none for null ids.

    Where ``name`` is taken, underscores are put behind it.
    """
    name = free_name(encoded, name)
    schema = with_fields(encoded.schema, f"{name} binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _decoder(ranks_path).decode
        for batch in batches:
            texts = pa.array([found(i or b"") for i in batch.column(ids).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, name])

    return map_batches(encoded, run, schema)
