"""Tolerant conversions: a value that does not convert becomes NULL.

Session mode is ANSI, where a bare cast of dirty text raises, so every
conversion of source text goes through one of these.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.functions.text import blank_to_null, decoded, text, trimmed

# The accepted spellings of numbers and dates.
PLAIN_DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
COMPACT_DAY = r"^[0-9]{8}$"


def to_int(c: Column) -> Column:
    return trimmed(c).try_cast("int")


def to_bigint(c: Column) -> Column:
    return trimmed(c).try_cast("bigint")


def to_money(c: Column, precision: int = 19, scale: int = 4) -> Column:
    """Decimal amount; exponents and currency marks are not numbers here."""
    value = trimmed(c)
    return F.when(value.rlike(PLAIN_DECIMAL), value.try_cast(f"decimal({precision},{scale})"))


def money_or_zero(c: Column) -> Column:
    """As ``to_money`` but a blank field counts as zero."""
    return to_money(F.coalesce(blank_to_null(c), F.lit("0")))


def int_or_zero(c: Column) -> Column:
    return to_int(F.coalesce(blank_to_null(c), F.lit("0")))


def iso_date(c: Column) -> Column:
    """``yyyy-MM-dd`` text to a date; nothing shorter or looser is accepted.

    The pattern admits one spelling, so the plain cast decides only whether
    the day exists; it is far cheaper than a formatter.
    """
    value = trimmed(c)
    return F.when(value.rlike(ISO_DAY), value.try_cast("date"))


def compact_date(c: Column) -> Column:
    """Eight digits ``yyyyMMdd``, text or integer, to a date."""
    value = trimmed(c)
    iso = F.concat_ws(
        "-", F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2)
    )
    return F.when(value.rlike(COMPACT_DAY), iso.try_cast("date"))


def day_of(c: Column) -> Column:
    return F.to_date(c)


def to_flag(c: Column, yes: str = "Yes", no: str = "No") -> Column:
    return decoded(c, {yes: "1", no: "0"}, None, fold_case=False) == F.lit("1")


def flag_of(condition: Column) -> Column:
    """Two-valued flag: an unknown condition counts as false."""
    return F.coalesce(condition, F.lit(False))


def day_before(c: Column) -> Column:
    return F.date_sub(c, 1)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Milliseconds between two instants, in seconds."""
    millis = F.unix_millis(end) - F.unix_millis(start)
    return (millis / F.lit(1000)).cast("decimal(18,4)")


def seconds_crossed(start: Column, end: Column) -> Column:
    """Second boundaries between two instants, fractions ignored."""
    return F.unix_seconds(F.date_trunc("second", end)) - F.unix_seconds(F.date_trunc("second", start))


__all__ = [
    "to_int", "to_bigint", "to_money", "money_or_zero", "int_or_zero", "iso_date",
    "compact_date", "day_of", "to_flag", "flag_of", "day_before", "elapsed_seconds",
    "seconds_crossed", "text",
]
