"""Files of token planes: round trips, the library's ids, random access, damage."""

from __future__ import annotations

import gc
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparksales.llm import token_files
from sparksales.operators.staging import new_folder

from .cases import odd_documents, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def expected():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def a_file(documents, layout, block_ids):
    writer = token_files.FileWriter(3, layout, block_ids)
    records = [r for key, ids in documents for r in writer.add(key, np.array(ids, "<u4").tobytes())]
    return b"".join(r + b"\n" for r in [*records, *writer.finish()])


@pytest.mark.parametrize("layout", token_files.LAYOUTS)
@pytest.mark.parametrize("block_ids", [1, 7, 8, 64])
def test_round_trip(layout, block_ids):
    rng = random.Random(block_ids)
    documents = [(i or None, [rng.choice([0, 1, 10, 255, 256, 50256, 2**32 - 1]) for _ in range(rng.randrange(40))]) for i in range(30)]
    file = token_files.TokenFile(a_file(documents, layout, block_ids))
    assert (file.shard, file.documents, file.layout) == (3, 30, layout)
    assert file.keys.tolist() == [k or 0 for k, _ in documents]
    assert file.no_key.tolist() == [k is None for k, _ in documents]
    assert [file.document(i).tolist() for i in range(30)] == [ids for _, ids in documents]
    every = [i for _, ids in documents for i in ids]
    for _ in range(50):
        a = rng.randrange(len(every) + 1)
        b = rng.randrange(a, len(every) + 1)
        assert file.ids(a, b).tolist() == every[a:b]


def test_planes():
    ids = np.array([1, 2, 3, 256, 65536], "<u4")
    low, second, third, highest = token_files.to_planes(ids, "byte")
    assert (low, second, third, highest) == (b"\1\2\3\0\0", b"\0\0\0\1\0", b"\0\0\0\0\1", b"\0" * 5)
    bits = token_files.to_planes(ids, "bit")
    assert len(bits) == 32 and bits[0] == bytes([0b10100000]) and bits[8] == bytes([0b00010000])
    with pytest.raises(ValueError):
        token_files.FileWriter(0, "word")


def test_small_ids_take_little_space():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50_000, 100_000).tolist()
    assert len(a_file([(1, ids)], "byte", 1 << 16)) < 2.1 * len(ids)


def test_damage_is_noticed():
    data = bytearray(a_file([(1, list(range(200)))], "byte", 64))
    with pytest.raises(ValueError):
        token_files.TokenFile(data[:-3])
    plain = token_files.TokenFile(bytes(data))
    plain._checks = plain._checks + np.uint32(1)
    with pytest.raises(ValueError):
        plain.block(0)


def test_odd_documents(spark, expected):
    folder = new_folder(spark)
    token_files.write_tokens(odd_documents(spark), folder, PATH, end_id=2, block_ids=100, file_text_bytes=5000)
    rows = token_files.read_tokens(spark, folder).collect()
    rows.sort(key=lambda r: r.start)
    assert len(rows) == len(odd_texts())
    keys = [r.doc_key for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    start, every = 0, []
    for row in rows:
        ids = np.frombuffer(row.token_ids, "<u4").tolist()
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(row.token_ids))
        start, every = start + len(ids), every + ids
    got = sorted((r.doc_key is None, r.doc_key or 0, np.frombuffer(r.token_ids, "<u4").tolist()) for r in rows)
    assert got == sorted((k is None, k or 0, expected(t)) for k, t in odd_texts())
    assert token_files.read_range(spark, folder, 0, start).tolist() == every
    assert token_files.read_range(spark, folder, start // 3, start // 2).tolist() == every[start // 3 : start // 2]


def test_stretches(expected):
    encoder = token_files.StretchEncoder(PATH)
    assert encoder._splits
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab  \n\t'stre1é漢😀.,-  \x1c\x85\xa0<|endoftext|>") for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts += ["a <|endoftext|> b", "   ", " a", "a ", "x" * 3000, ""]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == expected(text)[:-1], repr(text)


def test_caches_do_not_change_ids(expected, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_CHARS", 9)
    encoder = token_files.StretchEncoder(PATH)
    for text in ("one two three four", "two three.\nOne", "one four. five", "w" * 100 + " one", "w" * 100, "one\ntwo, 3\n\nfour don't\n's"):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == expected(text)[:-1]


def test_empty_table(spark):
    folder = new_folder(spark)
    token_files.write_tokens(odd_documents(spark).limit(0), folder, PATH, end_id=2)
    assert token_files.read_tokens(spark, folder).count() == 0
    assert len(token_files.read_range(spark, folder, 0, 10)) == 0


def test_no_collections_while_texts_are_encoded():
    encoder = token_files.StretchEncoder(PATH)
    texts = [" ".join(f"w{i}x{j}." for j in range(300)) for i in range(100)]
    runs = []
    gc.callbacks.append(count := lambda phase, info: runs.append(phase))
    try:
        found = encoder.encode(texts)
    finally:
        gc.callbacks.remove(count)
    assert not runs and gc.isenabled()
    assert found == [encoder._alone([text])[0] for text in texts]


def test_plain_parts_are_looked_at_many_at_a_time(expected, monkeypatch):
    looks, plain = [], token_files._PLAIN_LINES
    monkeypatch.setattr(token_files, "_PLAIN_LINES", lambda part: looks.append(part) or plain(part))
    encoder = token_files.StretchEncoder(PATH)
    texts = [f"one\ntwo{i} " + " ".join(f"w{i}x{j}" for j in range(100)) for i in range(40)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == expected(text)[:-1]
    assert len(looks) < 40
