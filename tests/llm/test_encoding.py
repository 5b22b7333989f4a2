"""Byte-level BPE against the tiktoken library, and its table under appends and edits."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from sparksales.llm import byte_bpe, shipping

from .cases import odd_documents, odd_texts

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def expected(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def test_odd_documents(spark, expected):
    docs = odd_documents(spark)
    encoded = byte_bpe.encode(docs, PATH, PATTERN, keep=("doc_id", "text"))
    rows = byte_bpe.decode(encoded, PATH).collect()
    assert len(rows) == len(odd_texts())
    once = byte_bpe.encode(docs, PATH, PATTERN, keep=("doc_id", "text"), decoded="decoded")
    assert sorted(once.collect(), key=repr) == sorted(rows, key=repr)
    for row in rows:
        assert ids(row.token_ids) == expected(row.text or "")
        assert bytes(row.decoded).decode() == (row.text or "")


def test_random_texts(ranks, expected):
    encoder = byte_bpe.TextEncoder(ranks, PATTERN)
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice("ab  \n\t'stre1é漢😀.,-  \x1c\x85") for _ in range(rng.randrange(60)))
        assert ids(encoder.encode(text)) == expected(text), repr(text)
    for size in (1, 127, 128, 129, 500):
        for unit in ("a", " ", "ab", "-", "é", "\n"):
            assert ids(encoder.encode(unit * size)) == expected(unit * size)


def test_another_pattern(ranks):
    pattern = r"\S+|\s+"
    encoder = byte_bpe.TextEncoder(ranks, pattern)
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for text in ("a b", "don't stop", "x  y", " lead.", "word. word!"):
        assert ids(encoder.encode(text)) == plain.encode_ordinary(text)


def test_appends_and_edits(ranks):
    encoder = byte_bpe.PrefixEncoder(ranks)
    rng = random.Random(2)
    data = bytes(rng.choice(b"theandingerstion") for _ in range(900))
    table = byte_bpe.PrefixTable(encoder, data[:10])
    table.append(data[10:500])
    table.append(data[500:])
    assert table.ids() == encoder.encode(data)
    assert table.ids(77) == encoder.encode(data[:77])
    for _ in range(30):
        start = rng.randrange(len(data))
        end = min(len(data), start + rng.randrange(6))
        by = bytes(rng.choice(b"theand") for _ in range(rng.randrange(6)))
        computed = table.replace(start, end, by)
        data = data[:start] + by + data[end:]
        assert table.ids() == encoder.encode(data)
        assert computed <= len(by) + 4 * encoder.longest


def test_small_caches_change_nothing(ranks, expected, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_BYTES", 2000)
    monkeypatch.setattr(byte_bpe, "ENTRY_BYTES", 1)
    monkeypatch.setattr(byte_bpe, "CACHED_PAIRS", 5)
    encoder = byte_bpe.TextEncoder(ranks, PATTERN)
    rng = random.Random(4)
    for _ in range(300):
        text = " ".join("".join(rng.choice("thenads.") for _ in range(rng.randrange(1, 9))) for _ in range(20))
        assert ids(encoder.encode(text)) == expected(text)
    assert encoder._piece.held < 2100 and encoder._stretch.held < 2100


def test_what_stands_at_a_tokens_ends_is_worked_out_once(ranks, monkeypatch):
    encoder = byte_bpe.PrefixEncoder(ranks)
    asked, halves = [], encoder.halves
    monkeypatch.setattr(encoder, "halves", lambda token: asked.append(token) or halves(token))
    first = [list(encoder._edge(ranks[b" the"], side)) for side in (0, 1)]
    count = len(asked)
    assert count and [list(encoder._edge(ranks[b" the"], side)) for side in (0, 1)] == first
    assert len(asked) == count


def test_decoding_beside_a_column_of_that_name(spark):
    rows = [(1, bytearray(b"\x00\x00\x00\x00"), "x"), (2, None, None)]
    encoded = spark.createDataFrame(rows, "doc_id int, token_ids binary, decoded string")
    found = byte_bpe.decode(encoded, PATH)
    assert found.columns == ["doc_id", "token_ids", "decoded", "decoded_"]
    assert [(r.decoded, bytes(r.decoded_)) for r in found.orderBy("doc_id").collect()] == [("x", b"!"), (None, b"")]


def test_empty_table(spark):
    docs = odd_documents(spark).limit(0)
    assert byte_bpe.encode(docs, PATH, PATTERN).count() == 0


def test_rows_are_decoded_together(ranks, expected):
    tokens = {rank: token for token, rank in ranks.items()}
    texts = ["", "one two", "é漢😀", "", "  \n x"]
    rows = [np.array(expected(text), "<u4").tobytes() for text in texts]
    decoder = byte_bpe.TokenBytes(tokens)
    for some in (rows, [], [b""]):
        found = decoder.decode_rows(some)
        assert found.type == pa.binary()
        assert found.to_pylist() == [decoder.decode(row) for row in some]
    assert [row.decode() for row in decoder.decode_rows(rows).to_pylist()] == texts
    with pytest.raises(KeyError):
        byte_bpe.TokenBytes({0: b"a", 2: b"b"}).decode_rows([np.array([1], "<u4").tobytes()])


def test_parts_of_a_batch_are_bounded_and_whole():
    texts = [None, "é" * 30, "", "b" * 500, *["c" * 10] * 40, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["n", "t"])
    for some in (batch, batch.slice(3, 20), batch.slice(0, 0)):
        parts = list(byte_bpe.byte_slices(some, "t", 100))
        assert [row for part in parts for row in part.to_pylist()] == some.to_pylist()
        assert all(sum(len(t or "") for t in part["t"].to_pylist()[:-1]) < 100 for part in parts)
        assert len(parts) < 12


def test_memory_is_given_back_after_each_task_and_large_group(monkeypatch):
    given_back = []
    monkeypatch.setattr(shipping, "release", lambda: given_back.append(1))
    over = shipping.releasing(lambda batches: (2 * b for b in batches))
    rows = over(iter([1, 2]))
    assert next(rows) == 2 and not given_back
    assert list(rows) == [4] and len(given_back) == 1
    small, large = pa.table({"x": [1]}), pa.table({"x": np.zeros(1 << 18)})
    assert shipping.releasing_groups(lambda table: table)(small) is small and len(given_back) == 1
    assert shipping.releasing_groups(lambda key, table: (key, table))(1, large) == (1, large) and len(given_back) == 2
    assert shipping.releasing_groups(lambda key, a, b: b)(1, large, small) is small and len(given_back) == 3
    monkeypatch.undo()
    shipping.release()
