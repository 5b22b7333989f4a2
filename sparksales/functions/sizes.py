"""Garment sizes as an ordinal scale."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Size -> rank.
SIZE_RANKS = {
    "FREE": 0,
    "XS": 1,
    "S": 2,
    "M": 3,
    "L": 4,
    "XL": 5,
    "XXL": 6,
    "3XL": 7,
    "4XL": 8,
    "5XL": 9,
    "6XL": 10,
}
UNKNOWN_RANK = -1


def size_rank(size: Column) -> Column:
    ranks = F.create_map(*[F.lit(part) for part in chain.from_iterable(SIZE_RANKS.items())])
    return F.coalesce(F.try_element_at(ranks, F.upper(F.trim(size))), F.lit(UNKNOWN_RANK))
