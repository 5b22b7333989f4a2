"""Ranked search against scoring every document, and its bounds."""

from __future__ import annotations

import math
import random
import re
import weakref
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sparksales.llm import ranked_search

from .cases import odd_documents, odd_texts, sentence

TERMS = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERMS.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def plain_search(docs, items, k):
    """(item, rank, doc_id, score) by definition; an item asks for the terms of all its rows."""
    counted = [(key, Counter(terms_of(text))) for key, text in docs]
    counted = [(key, c) for key, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    rows = []
    for item, terms in asked.items():
        found = []
        for key, c in counted:
            m = 100 - 90 + 90 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        rows += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(found)[:k], 1)]
    return sorted(rows, key=repr)


def run(docs, items, **options):
    found = ranked_search.search(docs, items, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted([tuple(row) for row in found.collect()], key=repr)


ITEMS = [
    (1, "w1 W2 w3 w1"),
    (2, None),
    (3, ""),
    (4, "nowhere"),
    (None, "one w5"),
    (5, "w7 w8"),
    (5, "w9 größe ça"),
    (6, " ".join(f"w{i}" for i in range(300))),
    (6, "na"),
    (7, "ünïcode x!ab"),
]


def test_odd_documents(spark):
    items = spark.createDataFrame([(k, t, 1) for k, t in ITEMS], "item_id bigint, text string, score int")
    assert run(odd_documents(spark), items) == plain_search(odd_texts(), ITEMS, 10)


def test_queries_in_blocks(spark):
    items = spark.createDataFrame([(str(k), t) for k, t in ITEMS], "name string, body string")
    expected = plain_search(odd_texts(), [(str(k), t) for k, t in ITEMS], 3)
    assert run(odd_documents(spark), items, k=3, item_text="body", item_key="name", query_pairs=40) == expected


def zipf_texts(count, seed):
    rng = random.Random(seed)
    topics = [[f"t{t}x{i}" for i in range(30)] for t in range(12)]
    texts = []
    for i in range(count):
        topic = topics[rng.randrange(12)]
        words = [rng.choice(topic) if rng.random() < 0.4 else f"w{int(rng.paretovariate(0.6)) % 500}" for _ in range(rng.randrange(5, 80))]
        texts.append((i, " ".join(words)))
    # A third of all documents are equal, and one word is in most.
    return texts + [(count + i, "the same text w1 w2 t3x4") for i in range(count // 2)]


@pytest.mark.parametrize("block_docs, shard_docs", [(4, 100), (16, 4096)])
def test_blocks_lose_nothing(spark, monkeypatch, block_docs, shard_docs):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block_docs)
    texts = zipf_texts(600, 3)
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, text in texts for t in terms_of(text)}))}
    rng = random.Random(4)
    items = [(i, " ".join(rng.sample(texts[rng.randrange(600)][1].split(), 4))) for i in range(40)] + [(99, "same w1")]
    counted = [(key, Counter(terms_of(text))) for key, text in texts]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    weights = np.array([ranked_search.term_weight(n, df[t]) for t in vocabulary], np.int64)
    shards = []
    for at in range(0, len(texts), shard_docs):
        part = texts[at : at + shard_docs]
        found = [[vocabulary[t] for t in terms_of(text)] for _, text in part]
        row = ranked_search._shard([k for k, _ in part], [len(f) for f in found], found, (len(part), 0)).to_pylist()[0]
        shards.append(ranked_search.Shard(row, weights, n, total))
    expected, scored = plain_search(texts, items, 10), 0
    got = []
    for item, text in items:
        best, query = ranked_search.Best(10), np.array([vocabulary[t] for t in set(terms_of(text))], np.int64)
        own = np.zeros(len(weights), np.int64)
        own[query] = weights[query]
        for shard in shards:
            scored += shard.search(query[shard.largest[query] > 0], own, best)
        got += [(item, r, k, s) for r, (k, s) in enumerate(zip(best.keys.tolist(), best.scores.tolist()), 1)]
    assert sorted(got, key=repr) == expected
    assert scored < 0.6 * len(items) * len(texts)  # blocks and lists are skipped


def test_bounds_hold():
    texts = zipf_texts(300, 8)
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, text in texts for t in terms_of(text)}))}
    found = [[vocabulary[t] for t in terms_of(text)] for _, text in texts]
    row = ranked_search._shard([k for k, _ in texts], [len(f) for f in found], found, (len(texts), 0)).to_pylist()[0]
    weights = np.arange(1, len(vocabulary) + 1, dtype=np.int64)
    shard = ranked_search.Shard(row, weights, len(texts), 20_000)
    for term in range(len(vocabulary)):
        blocks = shard.blocks(term)
        assert sorted(blocks.docs.tolist()) == sorted(shard.list(term).tolist())
        scores, bounds = shard.scores(blocks.docs, weights), blocks.bounds(weights)
        for i, bound in enumerate(bounds.tolist()):
            assert scores[blocks.starts[i] : blocks.starts[i + 1]].max() <= bound


def test_wide_numbers():
    lengths = np.array([1, 10**9], np.int64)
    assert ranked_search.length_norms(lengths, 10**11, 10**13).tolist() == [10, 10 + 90 * 10**9 * 10**11 // 10**13]


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert run(odd_documents(spark).limit(0), items) == []
    assert run(odd_documents(spark), items.limit(0)) == []


def test_a_task_holds_one_shard_at_a_time():
    found = [np.array([0, 1, 1], np.int32), np.zeros(0, np.int32), np.array([1], np.int32)]
    row = ranked_search._shard([5, 6, None], [3, 2, 1], found, (3, 6))
    batch = pa.Table.from_batches([row] * 4).combine_chunks().to_batches()[0]
    held = []
    for shard in ranked_search.shards_of(iter([batch]), np.array([3, 2]), 12, 24):
        assert shard.keys.tolist() == [5, 0] and shard.no_key.tolist() == [False, True]
        assert all(earlier() is None for earlier in held)
        held.append(weakref.ref(shard))
        del shard
    assert len(held) == 4
