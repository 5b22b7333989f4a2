"""Tolerant text-to-type expressions. A bad value becomes null; nothing raises."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Everything up to and including the space counts as padding, so tabs and stray
# control characters go too (plain ``trim`` only removes spaces).
_PADDING = "".join(chr(code) for code in range(0x21))

DATE_PATTERN = "MM-dd-yy"


def clean(text: Column) -> Column:
    return F.btrim(text, F.lit(_PADDING))


def is_filled(text: Column) -> Column:
    return text.isNotNull() & (F.length(text) > 0)


def normalized(text: Column) -> Column:
    """Key for case-insensitive comparison of flags, on text that ``clean`` has seen."""
    return F.lower(F.trim(text))


def parse_long(text: Column) -> Column:
    return clean(text).try_cast("bigint")


def parse_row_id(text: Column) -> Column:
    """A whole number that may be written with a fraction, as float columns export it (``17.0``)."""
    return clean(text).try_cast("decimal(38,6)").try_cast("bigint")


def parse_double(text: Column) -> Column:
    return clean(text).try_cast("double")


def finite_or_null(value: Column) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def parse_date(text: Column, clamp: bool = False) -> Column:
    """``MM-dd-yy`` with two-digit years in 2000-2099.

    By default a day that the month does not have gives null. With ``clamp`` days
    up to 31 move back to the month's last day (``02-30-22`` is 2022-02-28).
    """
    trimmed = clean(text)
    if not clamp:
        return F.try_to_date(trimmed, DATE_PATTERN)
    well_formed = trimmed.rlike(r"^(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])-[0-9]{2}$")
    first = F.try_to_date(
        F.when(well_formed, F.concat(F.substring(trimmed, 1, 3), F.lit("01"), F.substring(trimmed, 6, 3))),
        DATE_PATTERN,
    )
    day = F.substring(trimmed, 4, 2).try_cast("int")
    return F.least(F.date_add(first, day - 1), F.last_day(first))


def month_start(date: Column) -> Column:
    """Month as a date: a cheaper grouping key than text. Format it after grouping."""
    return F.trunc(date, "MM")


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")
