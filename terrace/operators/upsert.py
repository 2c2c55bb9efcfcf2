"""Update matching rows and insert new ones; rows only in the target survive.

Parquet tables cannot be changed in place, so the result is the next state
of the whole table, to be written as a new version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERTED = "inserted"
UPDATED = "updated"
KEPT = "kept"


def rows_to_update(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target already holds."""
    return source.join(target.select(*keys), list(keys), "left_semi")


def rows_to_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not hold."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    stamp: Column | None = None,
    created: str | None = None,
    updated: str | None = None,
    action: str | None = None,
) -> DataFrame:
    """The next state of ``target`` after applying ``source``.

    Keys must be present and unique in both inputs (``with_keys_present`` and
    ``keep_one`` see to that). Columns the source lacks keep their value.
    ``created`` and ``updated`` name columns set from ``stamp``: the first on
    insert only, the second on insert and on every match, changed or not.
    ``action`` names an extra column telling what happened to each row.

    Source and target meet in one full outer join on the key.
    """
    keys = list(keys)
    incoming = source.select(
        *keys,
        *[F.col(c).alias(f"_s_{c}") for c in source.columns if c not in keys],
        F.lit(True).alias("_in_source"),
    )
    held = target.withColumn("_in_target", F.lit(True))
    merged = held.join(incoming, keys, "full")

    in_source = F.col("_in_source").isNotNull()
    in_target = F.col("_in_target").isNotNull()
    out: list[Column] = []
    for field in target.schema:
        c = field.name
        if c in keys:
            value = F.col(c)
        elif c == created:
            value = F.when(in_target, F.col(c)).otherwise(stamp)
        elif c == updated:
            value = F.when(in_source, stamp).otherwise(F.col(c))
        elif c in source.columns:
            value = F.when(in_source, F.col(f"_s_{c}")).otherwise(F.col(c))
        else:
            value = F.col(c)
        out.append(value.cast(field.dataType).alias(c))
    if action:
        what = F.when(~in_target, INSERTED).when(in_source, UPDATED).otherwise(KEPT)
        out.append(what.alias(action))
    return merged.select(*out)


def action_counts(merged: DataFrame, action: str) -> DataFrame:
    """One row: inserted, updated and kept rows of an upsert."""
    return merged.agg(
        *[F.count_if(F.col(action) == a).alias(f"rows_{a}") for a in (INSERTED, UPDATED, KEPT)]
    )
