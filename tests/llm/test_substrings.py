"""Substring dedup, over words and over bytes, against plain definitions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from sparksales.llm import blocks as dealing, recompression, repeats, suffix_array

from .cases import odd_documents, odd_texts, sentence, words_of


def repeated_words(rows, window):
    """{(id, text): (n_words, n_removed, kept)} by the definition; null ids come first."""
    order = {None: -(10**9)}
    first = {}
    for key, text in rows:
        words = words_of(text)
        for s in range(len(words) - window + 1):
            at, w = (order.get(key, key), s), tuple(words[s : s + window])
            first[w] = min(first.get(w, at), at)
    found = []
    for key, text in rows:
        words = words_of(text)
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < (order.get(key, key), s):
                gone |= set(range(s, s + window))
        found.append((key, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone)))
    return found


def repeated_bytes(rows, window):
    counts = Counter()
    for _, text in rows:
        data = (text or "").encode()
        counts.update(data[s : s + window] for s in range(len(data) - window + 1))
    found = []
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - window + 1):
            if counts[data[s : s + window]] > 1:
                gone[s : s + window] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        found.append((key, len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return found


def by_repr(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("window", [20, 3])
def test_words_of_odd_documents(spark, window):
    rows = odd_texts()
    got = recompression.remove_repeats(odd_documents(spark), window=window, rounds=2 if window == 20 else 1)
    got = [(r.doc_id, r.n_words, r.n_removed, bytes(r.kept_text)) for r in got.collect()]
    assert by_repr(got) == by_repr(repeated_words(rows, window))


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_words_with_any_number_of_rounds(spark, rounds):
    rng = random.Random(rounds)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(50)))) for i in range(60)]
    got = recompression.remove_repeats(odd_documents(spark, rows), window=8, rounds=rounds)
    got = [(r.doc_id, r.n_words, r.n_removed, bytes(r.kept_text)) for r in got.collect()]
    assert by_repr(got) == by_repr(repeated_words(rows, 8))


def test_words_removed_spans_and_kept_columns(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    docs = odd_documents(spark, [(1, passage), (2, f"a {passage} b")])
    rows = {r.doc_id: r for r in recompression.remove_repeats(docs, keep=("doc_id", "text", "block", "source")).collect()}
    assert [tuple(s) for s in rows[2].removed] == [(1, 26)] and bytes(rows[2].kept_text) == b"a b"
    assert rows[1].removed == [] and rows[2].block == 1 and rows[2].source == "s"


def test_equal_windows_have_equal_interior_symbols():
    """What a window takes as its anchor depends on the window alone."""
    rng = np.random.default_rng(3)
    window = rng.integers(1, 6, 20).astype(np.uint64)
    names = set()
    for _ in range(40):
        around = [rng.integers(1, 6, rng.integers(0, 30)).astype(np.uint64) for _ in range(2)]
        words = np.concatenate([around[0], window, around[1]])
        ends = np.zeros(1, np.int64), np.array([len(words)])
        levels = recompression.levels(words, np.zeros(len(words), np.int64), *ends, 2)
        _, name, word = recompression.anchors(levels, 20, np.array([len(around[0])]))
        names.add((int(name[0]), int(word[0]) - len(around[0])))
    assert len(names) == 1


@pytest.mark.parametrize("window", [200, 9])
def test_bytes_of_odd_documents(spark, window):
    rows = odd_texts()
    got = suffix_array.remove_repeats(odd_documents(spark), window=window)
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in got.collect()]
    assert by_repr(got) == by_repr(repeated_bytes(rows, window))


def test_suffix_order_and_shared_starts():
    rng = np.random.default_rng(1)
    for _ in range(300):
        data = rng.integers(0, rng.integers(1, 5), rng.integers(1, 60)).astype(np.uint8)
        raw = data.tobytes()
        assert suffix_array.suffix_array(data).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        window = int(rng.integers(1, 9))
        starts = np.arange(0, max(0, len(raw) - window + 1))
        cut = [raw[s : s + window] for s in starts]
        assert suffix_array.shared_starts(data, starts, window).tolist() == [cut.count(c) > 1 for c in cut]
    many = rng.integers(0, 5000, 3000)
    assert suffix_array.suffix_array(many).tolist() == sorted(range(3000), key=lambda i: many[i:].tolist())


def test_empty_tables(spark):
    docs = odd_documents(spark, [(1, "a")]).limit(0)
    assert recompression.remove_repeats(docs).count() == 0
    assert suffix_array.remove_repeats(docs).count() == 0


def dealt(rows, blocks):
    """{block: table} of (id, text) rows as ``text_blocks`` deals them."""
    fields = ("doc_key", "row_hash", "text")
    return {n: pa.table(dict(zip(fields, zip(*[(k, k, t) for k, t in rows[n::blocks]])))) for n in range(blocks)}


def exchange(tables, step):
    """What ``step`` makes of packed rows, by the value of their first column."""
    joined = pa.concat_tables(tables)
    to = joined["bucket"].to_numpy()
    made = {}
    for value in np.unique(to).tolist():
        part = joined.filter(pa.array(to == value))
        made[value] = step(value, part)
    return made


def spans_by_steps(texts, steps, seen):
    """{block: (row, first, last)} without Spark; ``seen`` gets the packed rows of each exchange."""
    first, second, third, fourth = steps
    sent = [first((pa.scalar(block),), table) for block, table in texts.items()]
    answered = exchange(sent, lambda _, part: second(part))
    compared = exchange(list(answered.values()), lambda block, part: third((pa.scalar(block),), texts[block], part))
    back = exchange(list(compared.values()), lambda _, part: fourth(part))
    seen += [pa.concat_tables(sent), pa.concat_tables(list(compared.values()))]
    return exchange(list(back.values()), lambda _, part: repeats.marked_starts(part))


def most_under_one_name(packed, kind):
    return max(Counter(repeats.received(packed, kind)["name"].tolist()).values(), default=0)


def test_bytes_of_one_passage_in_many_surroundings(monkeypatch):
    """Regions at the edges of a passage all differ; neither an array nor a name gets them all."""
    rng, letters = random.Random(8), "abcdefghijklmnopqrstuvwxyz "
    passage = "".join(rng.choices(letters, k=600))
    rows = [(i, "".join(rng.choices(letters, k=300)) + passage + "".join(rng.choices(letters, k=300))) for i in range(600)]
    monkeypatch.setattr(suffix_array, "SHARD_BYTES", 1 << 14)
    arrays, shared_starts = [], suffix_array.shared_starts
    monkeypatch.setattr(suffix_array, "shared_starts", lambda data, *rest: arrays.append(len(data)) or shared_starts(data, *rest))
    for blocks in (3, 60):
        texts, seen, arrays[:] = dealt(rows, blocks), [], []
        parts = suffix_array._regions(200, 64), suffix_array._decide(200), suffix_array._extract(200, 4), suffix_array._compare(200)
        found = spans_by_steps(texts, repeats.steps(4, *parts), seen)
        got = []
        for block, table in texts.items():
            gone = {n: set() for n in range(table.num_rows)}
            for row, first, last in zip(*found[block]):
                gone[row] |= set(range(first, last + 200))
            got += [(k, len(gone[n])) for n, k in enumerate(table["doc_key"].to_pylist())]
        assert sorted(got) == sorted((k, removed) for k, _, removed, _, _ in repeated_bytes(rows, 200))
        assert max(arrays, default=0) <= 1 << 14
        assert most_under_one_name(seen[0], repeats.OPEN) <= repeats.MOST_CLASSES * blocks
        assert most_under_one_name(seen[1], repeats.CROWDED) <= blocks


def test_words_of_one_passage_in_many_surroundings():
    """What arrives under one name, of a region or a window, grows with the blocks only."""
    rng = random.Random(9)
    passage = sentence(rng, 60, 10**6)
    rows = [(i, f"{sentence(rng, 30, 10**6)} {passage} {sentence(rng, 30, 10**6)}") for i in range(600)]
    blocks, seen = 3, []
    texts = dealt(rows, blocks)
    parts = recompression._regions(20, 2), recompression._decide, recompression._extract(20, 4), recompression._compare
    found = spans_by_steps(texts, repeats.steps(4, *parts), seen)
    got = []
    for block, table in texts.items():
        gone = {n: set() for n in range(table.num_rows)}
        for row, first, last in zip(*found[block]):
            gone[row] |= set(range(first, last + 20))
        got += [(k, len(gone[n])) for n, k in enumerate(table["doc_key"].to_pylist())]
    assert sorted(got) == sorted((k, removed) for k, _, removed, _ in repeated_words(rows, 20))
    assert most_under_one_name(seen[0], repeats.OPEN) <= repeats.MOST_CLASSES * blocks
    assert most_under_one_name(seen[1], repeats.OPEN) <= blocks


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("module, expected, window", [(suffix_array, repeated_bytes, 200), (recompression, repeated_words, 20)])
def test_packed_rows_do_not_grow_with_the_square_of_partitions(spark, many_partitions, monkeypatch, module, expected, window):
    rng = random.Random(10)
    passage = sentence(rng, 60, 10**6)
    rows = [(i, f"{sentence(rng, 40, 10**6)} {passage if i % 3 else i} {sentence(rng, 40, 10**6)}") for i in range(1500)]
    made, find_spans = [], module.find_spans
    monkeypatch.setattr(module, "find_spans", lambda *given: made.append(find_spans(*given)) or made[0])
    found = module.remove_repeats(odd_documents(spark, rows), window=window).collect()
    kept = [(r.doc_id, r.n_removed, bytes(r["kept" if module is suffix_array else "kept_text"])) for r in found]
    assert sorted(kept) == sorted((x[0], x[2], x[-1]) for x in expected(rows, window))
    assert made[0].count() <= 2 * dealing.LEAST_PAIRS


def test_blocks_and_buckets_go_by_the_texts(spark, many_partitions):
    docs = odd_documents(spark)
    blocks, buckets = dealing.block_counts(docs, F.octet_length("text"))
    assert 8 <= buckets < blocks and blocks * buckets <= 1024
    for total in (0, 5e3, 54.6e6, 109.2e6, 1.25e9, 72e9):
        for partitions in (1, 12, 211, 2000):
            blocks, buckets = dealing.dealt_into(total, partitions)
            assert total <= blocks * dealing.BLOCK_BYTES and total <= buckets * dealing.BUCKET_BYTES
            assert 1 <= blocks <= max(4 * partitions, 1 + total / dealing.BLOCK_BYTES)
            if total < 48e9:
                assert blocks * buckets <= max(1024, total / 4096)
