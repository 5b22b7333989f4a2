"""Documents with everything that is odd about documents, and plain definitions."""

from __future__ import annotations

import random

ODD_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "block int, row_hash string, name double, score string, statistics int, label string, token_ids string"
)


def sentence(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def odd_texts(seed: int = 5) -> list[tuple[int | None, str | None]]:
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows, shared passages."""
    rng = random.Random(seed)
    passage, other = sentence(rng, 60), sentence(rng, 33)
    long = sentence(rng, 3000)
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, "Ünïcode\tÇa va?  Größe 漢字 😀  x"),
        (6, passage),
        (7, f"{sentence(rng, 15)} {passage} {sentence(rng, 9)}"),
        (8, f"{passage} {passage}"),
        (9, long),
        (10, long),
        (11, f"{sentence(rng, 7)} {long} {other}"),
        (12, "na " * 300),
        (13, "na " * 45),
        (13, other),
        (13, other),
        (None, passage),
        (None, other),
        (14, f"A{other}\n{sentence(rng, 40)}"),
        (15, "x" * 1000),
        (16, "ab" * 400),
    ]
    rows += [(100 + i, f"{sentence(rng, rng.randrange(60))} {other if i % 3 else passage}") for i in range(25)]
    return rows


def odd_documents(spark, rows=None):
    """The texts as a table that has extra columns with names the operators use themselves."""
    rows = odd_texts() if rows is None else rows
    full = [(k, t, "en", "s", None if t is None else len(t), 1, "r", 1.0, "s", 2, "l", "t") for k, t in rows]
    return spark.createDataFrame(full, ODD_SCHEMA).repartition(3)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()
