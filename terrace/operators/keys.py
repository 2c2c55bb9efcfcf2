"""Surrogate keys and continued id sequences over tables of any size.

An unpartitioned ``row_number`` moves the whole table into one task. Here
the rows are range-partitioned into slices, each row gets its place in its
slice, and a table with one row per slice holds the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.session import release, written

_PLACE = "_place"
_SLICE = "_slice"
# monotonically_increasing_id keeps the partition above bit 33.
_PARTITION_BITS = 33


def in_slices(df: DataFrame, order: Sequence[str], slices: int | None = None, unwritten: Sequence[str] = ()) -> DataFrame:
    """Globally sorted rows, cut into slices and written.

    Adds ``_slice`` and ``_place``; places rise along the global order. The
    order must be total, or rows that tie are numbered in any order. Without
    ``slices`` adaptive execution merges neighbouring small slices, so a small
    table does not become many tiny files. Columns named by ``unwritten`` serve the order only.
    """
    ordered = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(slices, *ordered) if slices else df.repartitionByRange(*ordered)
    placed = ranged.sortWithinPartitions(*ordered).withColumn(
        _PLACE, F.monotonically_increasing_id()
    )
    rows = written(placed.drop(*unwritten), "slices")
    release(df.sparkSession)
    return rows.withColumn(_SLICE, F.shiftright(_PLACE, _PARTITION_BITS))


def slice_offsets(sliced: DataFrame) -> DataFrame:
    """Rows before each slice. One row per slice, so the window is bounded."""
    sizes = sliced.groupBy(_SLICE).agg(
        F.count(F.lit(1)).alias("_n"), F.min(_PLACE).alias("_first")
    )
    before = F.sum("_n").over(Window.orderBy(_SLICE)) - F.col("_n")
    return sizes.select(_SLICE, "_first", before.alias("_before"))


def dense_key(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    first: int = 1,
    slices: int | None = None,
    unwritten: Sequence[str] = (),
) -> DataFrame:
    """Number the rows ``first, first + 1, ...`` along ``order`` without gaps; columns ``unwritten`` are left out."""
    sliced = in_slices(df, order, slices, unwritten)
    offsets = F.broadcast(slice_offsets(sliced))
    number = F.col("_before") + F.col(_PLACE) - F.col("_first") + first
    return sliced.join(offsets, _SLICE).select(number.cast("bigint").alias(name), *[c for c in df.columns if c not in unwritten])


def highest_number(df: DataFrame, c: str) -> DataFrame:
    """Largest value of a column that may hold text which is no number."""
    return df.agg(F.max(F.trim(F.col(c).cast("string")).try_cast("bigint")).alias("highest"))


def _numbered_text(c: Column, prefix: str) -> Column:
    return c.startswith(prefix) & (F.length(c) > len(prefix))


def highest_prefixed(df: DataFrame, c: str, prefix: str) -> DataFrame:
    """Largest text, in text order, among those made of the prefix and more."""
    value = F.col(c)
    return df.filter(_numbered_text(value, prefix)).agg(F.max(value).alias("highest"))


def continue_numbers(existing: DataFrame, c: str, fresh: DataFrame, order: Sequence[str]) -> DataFrame:
    """Give new rows the ids after the highest existing one."""
    base = highest_number(existing, c).first()[0] or 0
    return dense_key(fresh, order, c, first=base + 1)


def continue_prefixed(
    existing: DataFrame, c: str, prefix: str, fresh: DataFrame, order: Sequence[str]
) -> DataFrame:
    """As ``continue_numbers`` for prefix + number; no zeros are padded in.

    Goes on after the largest number, not the largest text, so that no id is
    given twice when the numbers get longer. Labels without a number after
    the prefix do not count.
    """
    number = F.substring(F.col(c), len(prefix) + 1, 1 << 30).try_cast("bigint")
    base = existing.filter(_numbered_text(F.col(c), prefix)).agg(F.max(number)).first()[0]
    if base is None:
        raise ValueError(f"no value of {c} is {prefix!r} and a number")
    numbered = dense_key(fresh, order, "_number", first=base + 1)
    label = F.concat(F.lit(prefix), F.col("_number").cast("string"))
    return numbered.select(label.alias(c), *fresh.columns)


def append_rows(df: DataFrame, *more: DataFrame) -> DataFrame:
    """All rows of all inputs, columns matched by name."""
    for other in more:
        df = df.unionByName(other)
    return df
