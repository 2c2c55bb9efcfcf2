"""Version histories: successors, end dates, joins to the version in force."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.convert import day_before
from terrace.operators.keys import in_slices

def next_in_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
) -> DataFrame:
    """Add the value of the next row of the same key.

    Rows are range-partitioned by key and order, so a key of any size is spread
    over tasks; the successor of a slice's last row is the first row of the
    next slice. The input is read twice: pass a table, or the result of
    ``session.written`` when it is expensive.
    """
    sliced = in_slices(df, [*keys, *order])
    in_slice = Window.partitionBy("_slice", *keys).orderBy("_place")
    first_row = F.min_by(F.struct(*keys, F.col(value).alias("_value")), "_place")
    heads = sliced.groupBy("_slice").agg(first_row.alias("_head"))
    following = F.lead("_head").over(Window.orderBy("_slice"))
    bounds = heads.select("_slice", following.alias("_following"))
    same_key = F.lit(True)
    for key in keys:
        same_key &= F.col(key).eqNullSafe(F.col(f"_following.{key}"))
    inside = (
        sliced.withColumn("_is_last", F.lead("_place").over(in_slice).isNull())
        .withColumn("_inside", F.lead(value).over(in_slice))
    )
    last_of_slice = F.col("_is_last") & F.col("_following").isNotNull() & same_key
    successor = F.when(last_of_slice, F.col("_following._value")).otherwise(F.col("_inside"))
    return inside.join(F.broadcast(bounds), "_slice").select(*df.columns, successor.alias(name))


def with_end_dates(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    tie: Sequence[str] = (),
    mode: str = "repair",
) -> DataFrame:
    """Close each version the day before the next one starts.

    ``repair`` touches only an end lying before its start and keeps the rest,
    ``recompute`` derives every end. The last version stays open.
    """
    if mode not in ("repair", "recompute"):
        raise ValueError(f"unknown mode {mode!r}")
    chained = next_in_key(df, keys, [start, *tie], start, "_next_start")
    derived = day_before(F.col("_next_start"))
    if mode == "repair":
        derived = F.when(F.col(end) < F.col(start), derived).otherwise(F.col(end))
    return chained.withColumn(end, derived).drop("_next_start")


def current_only(df: DataFrame, end: str) -> DataFrame:
    return df.filter(F.col(end).isNull())


def close_versions(df: DataFrame, keys: DataFrame, key: str, end: str, on: Column) -> DataFrame:
    """Set the end of the still open versions of the listed keys.

    Open means NULL or, in raw text, blank. ``on`` has the type of ``end``.
    """
    listed = keys.select(F.col(key), F.lit(True).alias("_listed")).distinct()
    still_open = F.col(end).isNull() | (F.trim(F.col(end).cast("string")) == "")
    closed = F.when(F.col("_listed") & still_open, on).otherwise(F.col(end))
    return df.join(listed, key, "left").withColumn(end, closed).select(*df.columns)


def join_current(fact: DataFrame, versions: DataFrame, fact_key: str, version_key: str) -> DataFrame:
    """Left join on the key alone; the caller passes current versions only."""
    return fact.join(versions, fact[fact_key] == versions[version_key], "left")


def join_version_in_force(
    fact: DataFrame,
    versions: DataFrame,
    fact_key: str,
    version_key: str,
    day: str,
    start: str,
    end: str,
) -> DataFrame:
    """Left join each fact row to the versions valid on its day.

    Start and end days are included, an open end reaches forever, a row
    without a version is kept. Overlapping versions each give a row.

    Each version is listed under every year it touches, so a row meets only
    the versions of its own year, however many its key has. Rows without a key or a
    day match nothing and stay out of the join, where they would meet in one task.
    """
    # Past the last year with a start only one more bin is needed: the versions
    # alive there are the open or last ones of each key.
    last_bin = (versions.agg(F.max(F.year(start))).first()[0] or 0) + 1
    can_match = F.col(end).isNull() | (F.col(end) >= F.col(start))
    until = F.least(F.coalesce(F.year(end), F.lit(last_bin)), F.lit(last_bin))
    binned = versions.filter(F.col(start).isNotNull() & can_match).withColumn(
        "_year", F.explode(F.sequence(F.year(start), until))
    )
    dated = fact.withColumn(
        "_day_year", F.when(F.year(day) > last_bin, F.lit(last_bin)).otherwise(F.year(day))
    )
    matches = (
        (dated[fact_key] == binned[version_key])
        & (dated["_day_year"] == binned["_year"])
        & (dated[day] >= binned[start])
        & ((dated[day] <= binned[end]) | binned[end].isNull())
    )
    can_have = F.col(fact_key).isNotNull() & F.col(day).isNotNull()
    joined = dated.filter(can_have).join(binned, matches, "left").drop("_day_year", "_year")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in versions.schema]
    return joined.union(fact.filter(~can_have).select("*", *nothing))
