"""Collocations against counting every phrase, and the trie under bursts and spills."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from sparksales.llm import collocations

from .cases import odd_documents, odd_texts

SCHEMA = "lang string, text string, phrase int, f string, part int, score string, rank string"


def pieces_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", piece) if w] for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def plain_counts(rows, most_words):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            sizes[lang] += len(words)
            for n in range(1, most_words + 1):
                counts.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    return counts, sizes


def plain_collocations(rows, least, most_words=5, keep_percent=100, first=2000):
    counts, sizes = plain_counts(rows, most_words)
    frequent = {k: f for k, f in counts.items() if len(k[1]) > 1 and f >= least}
    inside = Counter()
    for (lang, words), f in frequent.items():
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                inside[lang, words[i : i + n]] = max(inside[lang, words[i : i + n]], f)
    found = {}
    for (lang, words), a in frequent.items():
        if (lang, words) in inside and 100 * inside[lang, words] >= keep_percent * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * sizes[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), a, left, right, sizes[lang], score))
    rows = []
    for lang, own in found.items():
        rows += [(lang, i, p.decode(), *rest) for i, (_, _, p, *rest) in enumerate(sorted(own)[:first], 1)]
    return sorted(rows)


def run(docs, **options):
    found = collocations.collocations(docs, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(row) for row in found.collect())


def some_rows(seed=3):
    rng = random.Random(seed)
    fixed = ["new york city", "out of the blue", "as soon as possible then", "É À", "a\x01 b", "x\x85y z\xa0w"]
    rows = [(None, None), ("en", ""), ("fr", None), (None, "a.b"), ("und", "out of the blue"), ("en", "New YORK\tcity " * 40)]
    for i in range(300):
        words = [rng.choice(fixed) if rng.random() < 0.3 else f"w{int(rng.paretovariate(0.8)) % 60}" for _ in range(rng.randrange(30))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\x0b", ":", ";"]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "fr", None]), text))
    return rows + [("en", "the very same passage of words again")] * 150


def as_table(spark, rows):
    return spark.createDataFrame([(lang, text, 1, "f", 2, "s", "r") for lang, text in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(
    "options", [{"least": 4}, {"least": 7, "most_words": 3, "keep_percent": 60, "first": 5}, {"least": 3, "most_words": 2}]
)
def test_by_definition(spark, options):
    rows = some_rows()
    assert run(as_table(spark, rows), **options) == plain_collocations(rows, **options)


def test_bursts_and_spills_lose_nothing():
    """Every phrase, by tries that burst and spill all the time."""
    limits = {"BURST": 3, "MOST_ENTRIES": 150, "MOST_NUMBERED": 40}
    rows, runs = some_rows()[:200], []
    for lengths in (range(1, 2), range(2, 3), range(3, 6)):
        languages = {}
        for lang, text in rows:
            lang = "und" if lang is None else lang
            language = languages.setdefault(lang, collocations._Language(lang, lengths, None, None))
            for trie in language.tries.values():
                trie.burst = limits["BURST"]
            language.add([(text or "").encode()])
            if language.size > limits["MOST_ENTRIES"]:
                runs += language.runs(7, limits["MOST_ENTRIES"] // 2)
                assert language.size <= limits["MOST_ENTRIES"] // 2
            if len(language.numbered) > limits["MOST_NUMBERED"]:
                runs += language.runs(7, 0)
                language.start_numbering()
        for language in languages.values():
            runs += language.runs(7, 0)
            assert language.size == 0
    counts, homes = Counter(), {}
    for record in runs:
        for row in record.to_pylist():
            phrases = row["phrases"].split(b"\n")[:-1]
            assert phrases == sorted(phrases)
            for phrase, n in zip(phrases, np.frombuffer(row["counts"], np.int64).tolist(), strict=True):
                words = tuple(phrase.decode().split(" ")) if phrase else ()
                counts[row["lang"], words] += n
                prefix = (row["lang"], len(words) > 2, len(words) == 2, words[:3])
                assert homes.setdefault(prefix, row["part"]) == row["part"]
    expected, sizes = plain_counts(rows, 5)
    assert counts == expected | {(lang, ()): n for lang, n in sizes.items() if n}


def test_burst_keeps_counts():
    rng = random.Random(1)
    ids = np.array([rng.randrange(1, 9) for _ in range(3000)], np.int64)
    for length in (2, 3, 5):
        plain, burst = collocations.HatTrie(length), collocations.HatTrie(length, burst=5)
        for trie in (plain, burst):
            for at in range(0, 3000, 500):
                trie.add(ids[at : at + 500], np.arange(500 - length + 1))
        assert any(isinstance(node, dict) and not isinstance(node, Counter) for node in burst.nodes.values()) == (length > 2)
        assert plain.size == burst.size
        got = []
        for trie in (plain, burst):
            some = trie.spill(trie.size // 2)
            rest = trie.spill(0)
            assert trie.size == 0 and not trie.nodes
            rows = np.concatenate([some[0], rest[0]]).tolist()
            got.append(dict(zip(map(tuple, rows), np.concatenate([some[1], rest[1]]).tolist(), strict=True)))
        assert got[0] == got[1] and len(got[0]) == len(rows)


def test_filter_forgets_nothing():
    names = np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64)
    places = collocations.Filter.places(names, 1 << 12).ravel()
    slots = np.zeros(64, np.uint64)
    np.bitwise_or.at(slots, (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63)))
    assert collocations.Filter(slots).may_hold(names).all()


def test_odd_documents(spark):
    rows = [("en", text) for _, text in odd_texts()]
    assert run(odd_documents(spark), least=5) == plain_collocations(rows, 5)


def test_empty_table(spark):
    assert run(as_table(spark, some_rows()).limit(0), least=2) == []
    assert run(as_table(spark, [("en", None), (None, "one")]), least=2) == []
