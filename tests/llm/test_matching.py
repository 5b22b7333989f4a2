"""Near-duplicates, phrases, conversations and nearest neighbours against plain definitions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
import xxhash

from sparksales.llm import conversations, phrase_index, similarity_search, simhash
from sparksales.llm.components import connected_components

from .cases import odd_documents, odd_texts, sentence, words_of


def fingerprint(text, each):
    words = [w.lower() for w in words_of(text)]
    shingles = [b" ".join(words[i : i + each]) for i in range(max(1, len(words) - each + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near_components(rows, each, distance):
    """(id, fingerprint, smallest id of the component) of each row."""
    prints = [fingerprint(text, each) for _, text in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    smallest = {}
    for (key, _), at in zip(rows, label):
        if key is not None:
            smallest[at] = min(smallest.get(at, key), key)
    return [(key, f"{p:016x}", smallest.get(at)) for (key, _), p, at in zip(rows, prints, label)]


def near_texts():
    rng = random.Random(8)
    base = sentence(rng, 400)
    words = base.split()
    rows = odd_texts() + [(500 + i, base) for i in range(6)]
    for i in range(40):
        changed = list(words)
        changed[rng.randrange(len(words))] = f"c{i}"
        rows.append((600 + i, " ".join(changed).upper() if i % 2 else " ".join(changed)))
    return rows


@pytest.mark.parametrize("distance", [0, 4, 12])
def test_near_duplicates(spark, distance):
    rows = near_texts()
    got = simhash.near_duplicates(odd_documents(spark, rows), words_each=4, distance=distance).collect()
    got = [(r.doc_id, f"{r.fingerprint_bits % (1 << 64):016x}", r.component_id) for r in got]
    assert sorted(map(repr, got)) == sorted(map(repr, near_components(rows, 4, distance)))


def test_one_of_each(spark):
    rows = near_texts()
    docs = odd_documents(spark, rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    expected = {(component, fingerprint_) for _, fingerprint_, component in near_components(rows, 4, 4)}
    ids = [row.doc_id for row in kept.collect()]
    assert sorted(set(map(str, ids))) == sorted({str(c) for c, _ in expected})
    assert len(ids) == len({c for c, _ in expected})
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_shards_find_every_pair():
    rng = np.random.default_rng(2)
    points = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    flips = points[:800].copy()
    for _ in range(4):
        flips ^= np.uint64(1) << rng.integers(0, 64, 800, dtype=np.uint64)
    points = np.unique(np.r_[points, flips])
    router = simhash.Router(points[rng.permutation(len(points))[:500]], 4)
    shard, at, home = router.route(points, 4)
    assert np.bincount(at[home], minlength=len(points)).tolist() == [1] * len(points)
    joined = set()
    for s in np.unique(shard):
        mine = shard == s
        a, b = simhash.linked_in_shard(points[at[mine]], home[mine], 4)
        joined |= set(zip(a.tolist(), b.tolist()))

    def components(pairs):
        label = {int(p): int(p) for p in points}

        def root(x):
            while label[x] != x:
                x = label[x]
            return x

        for a, b in pairs:
            low, high = sorted((root(a), root(b)))
            label[high] = low
        return {x: root(x) for x in label}

    brute = []
    for i, p in enumerate(points):
        close = np.flatnonzero(np.bitwise_count(points[i + 1 :] ^ p) <= 4) + i + 1
        brute += [(int(p), int(q)) for q in points[close]]
    assert len(brute) > 700 and components(joined) == components(brute)


def test_long_chains_become_one_component(spark):
    links = [(i, i + 1) for i in range(150)] + [(1000, 1000), (2000, 2001), (2001, 2000)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(151)}, 2000: 2000, 2001: 2000}


def said(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c > "\x7f" or c.isdigit() and c.isascii() or "a" <= c <= "z" else " " for c in lowered).split(" ")


def contaminated(rows, items, size):
    phrases = {}
    for item, text in items:
        words = [w for w in said(text) if w]
        for i in range(max(1, len(words) - size + 1)) if words else ():
            phrases.setdefault(tuple(words[i : i + size]), set()).add("" if item is None else str(item))
    found = []
    for key, text in rows:
        words, hit, who = [w for w in said(text) if w], set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in phrases:
                    hit |= set(range(i, i + n))
                    who |= phrases[tuple(words[i : i + n])]
        found.append((key, len(words), len(hit), sorted(who)))
    return found


def test_phrases_of_odd_documents(spark):
    rng = random.Random(6)
    rows = odd_texts() + [(700, "Ünïcode-tÉxt, THE the ÉTÉ"), (701, "the the the the the the the the the the the the")]
    passage = rows[5][1]
    items = [
        (1, passage), (2, f"zz {passage}"), (2, f"zz {passage}"), (3, None), (4, ""), (5, "ünïcode ÉTÉ"), (6, "the ÉTÉ"),
        (7, "Ünïcode"), (8, "the " * 10), (9, sentence(rng, 30)), (None, "one"), (10, "na " * 11), (11, "never said before"),
    ]
    benchmark = spark.createDataFrame([(i, t, "t") for i, t in items], "item_id bigint, text string, term string")
    docs = odd_documents(spark, rows)
    got = phrase_index.contamination(docs, benchmark).collect()
    got = [(r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in got]
    expected = contaminated(rows, items, 10)
    assert sum(row[2] > 0 for row in expected) > 10
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    clean = phrase_index.clean(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == sum(row[2] == 0 for row in expected)


def test_phrases_of_empty_tables(spark):
    docs = odd_documents(spark)
    benchmark = spark.createDataFrame([(1, "one")], "item_id bigint, text string")
    assert {r.n_hit for r in phrase_index.contamination(docs, benchmark.limit(0)).collect()} == {0}
    assert phrase_index.contamination(docs.limit(0), benchmark).count() == 0


def test_a_shuffled_look_up_gives_the_same(spark, monkeypatch):
    rows, items = odd_texts(), [(1, odd_texts()[5][1])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(phrase_index, "BROADCAST_BYTES", 0)
    got = phrase_index.contamination(odd_documents(spark), benchmark).collect()
    assert sorted(repr((r.doc_id, r.n_words, r.n_hit, list(r.item_ids))) for r in got) == sorted(map(repr, contaminated(rows, items, 10)))


def test_words_near_each_other(spark):
    texts = [(1, "a x b x x a"), (2, "b a"), (3, "a x x x x x b")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    pairs = spark.createDataFrame([("a", "b")], "a string, b string")
    got = {(r.doc_id, r.position_a, r.position_b) for r in phrase_index.near_each_other(docs, pairs, 3).collect()}
    assert got == {(1, 0, 2), (1, 5, 2), (2, 1, 0)}


def test_main_path_of_native_operators_has_no_python(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi")], "conv_id bigint, turn bigint, role string, text string")
    plan = conversations.collapse_and_render(turns)._jdf.queryExecution().executedPlan().toString()
    docs, items = odd_documents(spark), spark.createDataFrame([(1, "one")], "item_id bigint, text string")
    plan += phrase_index.contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_conversations(spark):
    long = [("user", f"t{i}") if i % 2 else ("bot", f"t{i}") for i in range(2500)]
    logged = {
        1: long[:3], 2: long[:5], 3: long, 4: long, 5: [("user", None)], 6: [("user", "")], 7: [(None, "x")],
        8: [("user", "t0")], 9: [("user", ""), ("bot", "y")], None: [("user", "lost")], 10: long[1:4],
    }
    rows = [(conv, n, role, text, 1) for conv, turns in logged.items() for n, (role, text) in enumerate(turns)]
    rows += [(8, 0, "user", "t0", 1)]  # a repeated row
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, nth int").repartition(4)
    got = {r.conv_id: (r.n_turns, r.n_copies, r.text) for r in conversations.collapse_and_render(turns).collect()}

    def is_prefix(a, b):
        return len(a) < len(b) and b[: len(a)] == a

    expected = {}
    for conv, own in logged.items():
        equal = [c for c, other in logged.items() if other == own]
        if any(is_prefix(own, other) for other in logged.values()) or conv != min(equal, key=lambda c: (c is not None, c or 0)):
            continue
        text = "".join(f"<|im_start|>{role or ''}\n{said_ or ''}<|im_end|>\n" for role, said_ in own)
        expected[conv] = (len(own), len(equal), text)
    assert got == expected
    assert conversations.collapse_and_render(turns.limit(0)).count() == 0


def plain_chats(rows):
    """(conv_id, n_turns, n_copies, text) by definition: null turn numbers first, then by role and text."""
    first = lambda value: (value is not None, value if value is not None else 0)
    by_id = {}
    for conv, turn, role, text in set(rows):
        by_id.setdefault(conv, []).append((first(turn), (role is not None, role or ""), (text is not None, text or "")))
    said = {conv: [(role, text) for _, role, text in sorted(turns)] for conv, turns in by_id.items()}
    kept = {}
    for conv, turns in said.items():
        if not any(len(other) > len(turns) and other[: len(turns)] == turns for other in said.values()):
            kept.setdefault(tuple(turns), []).append(conv)
    rendered = []
    for turns, convs in kept.items():
        text = "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for (_, role), (_, text) in turns)
        rendered.append((min(convs, key=lambda c: (c is None, c or 0)), len(turns), len(convs), text))
    return sorted(rendered, key=repr)


def test_tied_and_null_turns_and_long_texts(spark):
    long = "x y " * 200_000
    rows = [
        (1, None, "user", "first"), (1, None, "system", "zero"), (1, 3, "user", "b"), (1, 3, "user", "a"), (1, 3, None, "a"),
        (2, None, "system", "zero"), (2, None, "user", "first"),
        (3, 1, "user", long), (3, 2, "user", None), (4, 1, "user", long),
        (5, 7, "user", "same"), (6, 900_000, "user", "same"), (6, 900_000, "user", "same"),
        (None, 1, "user", "of nobody"), (None, None, None, None),
        (7, None, None, None),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").repartition(3)
    assert sorted(map(tuple, conversations.collapse_and_render(turns).collect()), key=repr) == plain_chats(rows)


def test_nearest_neighbours(spark, monkeypatch):
    monkeypatch.setattr(similarity_search, "QUERIES_PER_BLOCK", 7)
    monkeypatch.setattr(similarity_search, "CANDIDATES_PER_BLOCK", 40)
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=16) * 10.0 ** rng.integers(-3, 4) for i in range(300)}
    vectors |= {i: vectors[50] for i in range(300, 360)} | {400: np.r_[1e-30, np.zeros(15)], 401: rng.normal(size=3)}
    rows = [(i, [float(x) for x in v]) for i, v in vectors.items()]
    rows += [(600, None), (601, []), (602, [0.0] * 16), (603, [1.0] * 15 + [math.nan]), (604, [1.0] * 15 + [None]),
             (605, [math.inf] + [1.0] * 15), (None, [1.0] * 16), (50, rows[50][1])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, dims int")
    got = similarity_search.nearest(table.where("vec_id % 50 = 0"), table).collect()
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got}
    expected = {}
    for q in [i for i in vectors if i % 50 == 0]:
        ranked = []
        for c, v in vectors.items():
            if c != q and len(v) == len(vectors[q]):
                cosine = float(vectors[q] @ v / (np.linalg.norm(vectors[q]) * np.linalg.norm(v)))
                ranked.append((-round(cosine, 12), c))
        expected |= {(q, n): (c, -s) for n, (s, c) in enumerate(sorted(ranked)[:5], 1)}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in expected.items()}
    assert all(got[k][1] == pytest.approx(expected[k][1], abs=1e-12) for k in got)
    assert similarity_search.nearest(table.limit(0), table.limit(0)).count() == 0
