"""Keep one row per key.

``row_number() = 1`` is planned with a group limit on both sides of the
shuffle: each task sends at most one row per key, so a key holding a large
share of all rows does not reach one task in full.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.convert import iso_date
from terrace.functions.text import is_present
from terrace.session import written

FEW_REPEATED = 500_000  # hashes of keys, sent to every task


def with_keys_present(df: DataFrame, keys: Sequence[str], blank_is_missing: bool = True) -> DataFrame:
    """Drop rows lacking a key: NULL always, blank text unless told otherwise."""
    test = F.lit(True)
    for key in keys:
        test &= is_present(F.col(key)) if blank_is_missing else F.col(key).isNotNull()
    return df.filter(test)


def rejected_count(df: DataFrame, keys: Sequence[str], blank_is_missing: bool = True) -> DataFrame:
    """One row: how many rows ``with_keys_present`` would drop, and how many there are."""
    missing = F.lit(False)
    for key in keys:
        missing |= ~is_present(F.col(key)) if blank_is_missing else F.col(key).isNull()
    return df.agg(F.count_if(missing).alias("rows_rejected"), F.count(F.lit(1)).alias("rows_read"))


def keep_one(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = ()) -> DataFrame:
    """The preferred row of each key; remaining ties go by all other columns."""
    others = [F.col(f"`{c}`").desc_nulls_last() for c in df.columns if c not in keys]
    ranking = Window.partitionBy(*keys).orderBy(*prefer, *(others or [F.lit(0)]))
    ranked = df.withColumn("_rank", F.row_number().over(ranking))
    return ranked.filter("_rank = 1").drop("_rank")


def where_repeated(df: DataFrame, keys: Sequence[str], choose: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``choose``, which keeps one row of each key, applied to the rows whose key occurs more than once.

    ``df`` is read twice, so it should be written. First only hashes of the keys are shuffled; where at most
    FEW_REPEATED of them repeat, all other rows pass without a shuffle. Keys of one hash are told apart by ``choose``.
    What it keeps is written, so the result, which depends on ``df`` besides, may be read several times.
    """
    coded = df.withColumn("_code", F.xxhash64(*keys))
    counted = coded.groupBy("_code").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_code")
    repeated = written(counted, "repeated")
    n = repeated.count()
    if n > FEW_REPEATED:
        return written(choose(df), "chosen")
    if not n:
        return df
    sent = F.broadcast(repeated)
    once = coded.join(sent, "_code", "left_anti").select(*df.columns)
    return once.unionByName(written(choose(coded.join(sent, "_code", "left_semi").select(*df.columns)), "chosen"))


def keep_last_in_file(df: DataFrame, keys: Sequence[str], row_number: str = "source_row_number") -> DataFrame:
    """The last row of the last file: by modification time, then path, then row number, as far as they are there."""
    order = [c for c in ("source_modified_at", "source_file", row_number) if c in df.columns]
    return keep_one(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_latest_date(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Latest date wins; text dates are compared as dates, unreadable ones last."""
    raw = F.col(date)
    is_text = dict(df.dtypes)[date] == "string"
    day = iso_date(raw) if is_text else raw
    return keep_one(df, keys, [day.desc_nulls_last(), raw.desc_nulls_last()])
