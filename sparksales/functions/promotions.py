"""Promotion-id lists: comma separated, padded with spaces, sometimes with empty items."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def promotion_list(text: Column) -> Column:
    """Distinct promotion ids of a row, in order of first appearance."""
    items = F.split(F.trim(F.coalesce(text, F.lit(""))), " *, *")
    return F.array_distinct(F.array_remove(items, ""))


def promotion_count(text: Column) -> Column:
    """Number of promotion ids of a row; repeated ids count each time.

    Counts the places where an item's text begins, without building the list.
    """
    return F.coalesce(F.regexp_count(text, F.lit("[^, ][^,]*")), F.lit(0)).cast("bigint")
