"""Upserts whose cost follows the delivery: only buckets of keys that it touches are read and rewritten.

A table in n buckets is published as a list of folders, one for each bucket that
has rows, told by a hash of the key. An upsert joins the delivery with the buckets its keys
fall into and writes these anew; the folders of all others stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.upsert import upsert
from terrace.session import release, written
from terrace.sources.layers import Layers

BUCKET = "bucket"
ROWS_PER_BUCKET = 250_000
FEW_KEPT = 100_000  # keys, sent to every task
PASSES = 4  # in which the rows of a table of several buckets are shuffled and written
MOST = 4096  # the list of folders is one line of the manifest


@dataclass(frozen=True)
class Upserted:
    """Folders of the next version, those among them that were written, and what happened to the rows."""

    paths: list[str]
    rewritten: list[str]
    inserted: int
    updated: int


def bucket_of(table: DataFrame, keys: Sequence[str], n: int) -> Column:
    """The bucket of a row; the key types are those of the table."""
    typed = [F.col(k).cast(table.schema[k].dataType) for k in keys]
    return F.pmod(F.xxhash64(*typed), F.lit(n)).cast("int")


def _numbers(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # at most n rows


def _merged(target: DataFrame, before: int, incoming: DataFrame, offered: int, keys: Sequence[str], stamps: dict) -> DataFrame:
    """As ``upsert``, without shuffling whole rows where the delivery brings all columns and few rows of the target stay.

    Then the next state is the delivery and the rows whose key it lacks; keys alone tell which these are. Keys
    that are missing or repeat in the target are left to ``upsert``.
    """
    same = all(f.name in incoming.columns and (f.name not in keys or incoming.schema[f.name].dataType == f.dataType) for f in target.schema)
    if stamps or not same or before - offered > FEW_KEPT:
        return upsert(target, incoming, keys, **stamps)
    new = incoming.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema])
    if not before:
        return new
    sides = target.select(*keys, F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionAll(new.select(*keys, F.lit(0), F.lit(1)))
    told = sides.groupBy(*keys).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    odd = reduce(or_, [F.col(k).isNull() for k in keys]) | (F.col("_old") > 1)
    stays = written(told.where((F.col("_new") == 0) | odd).withColumn("_odd", odd), "keys-that-stay")
    if not stays.where("_odd").isEmpty() or stays.count() > FEW_KEPT:
        return upsert(target, incoming, keys, **stamps)
    kept = target.join(F.broadcast(stays.select(*keys)), list(keys), "left_semi")
    return new.unionByName(kept.select(*new.columns))


def upsert_buckets(
    layers: Layers, layer: str, table: str, incoming: DataFrame, keys: Sequence[str], n: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET, at: datetime | None = None, **stamps,
) -> Upserted:
    """The next version of a published table after applying ``incoming``, which is read several times.

    Keys are present and unique in both (see ``upsert``, which gets ``stamps``). The number
    of buckets is ``n``, or follows ``rows_per_bucket``, at most MOST; a table that is not in so many yet, or whose
    buckets have grown four times too large, is read and rewritten whole, once. Inserts and
    updates are told by row counts from file footers of the buckets concerned, as nothing is ever deleted.
    Rows are shuffled and written in up to PASSES passes, each of its share of the buckets, so that shuffle files
    of one pass are gone when the next has begun. The version is published whole by the caller; but of a table that keeps no
    replaced versions the buckets of each pass but the last are published ``at`` once, so that old and new rows lie side by
    side for one share only. If a later pass fails, those buckets have the delivery; to apply it again does no harm.
    """
    held = layers.paths(layer, table)
    whole = layers.read(layer, table)
    offered = incoming.count()
    if not offered:
        return Upserted(held, [], 0, 0)
    told = [re.fullmatch(rf".*/of-(\d+)/{BUCKET}=(\d+)", p) for p in held]
    current = int(told[0][1]) if all(told) and len({m[1] for m in told}) == 1 else None
    known = {int(m[2]): p for m, p in zip(told, held)} if current else {}
    target, touched = whole, []
    if current and n in (None, current):
        touched = _numbers(incoming.withColumn(BUCKET, bucket_of(whole, keys, current)))
        old = [known[b] for b in touched if b in known]
        target = layers.read_paths(old, whole.schema) if old else whole.limit(0)
    before = target.count()
    wanted = n or current
    if touched and n is None and before > 4 * rows_per_bucket * len(touched) and current < MOST:
        touched, target, before = [], whole, whole.count()
    if not touched:
        wanted = n or min(MOST, max(1, -(-(before + offered) // rows_per_bucket)))
    bucket, path = bucket_of(whole, keys, wanted), f"{layers.new_path(layer, table)}/of-{wanted}"
    passes = min(PASSES, wanted, -(-(before + offered) // rows_per_bucket))
    stepwise, held_now = at is not None and not layers.keep_old and touched, dict(known)
    for k in range(passes):
        # Rows of one key are of one bucket, in the table and in the delivery.
        old, new = (rows.where(F.pmod(bucket, F.lit(passes)) == k) if passes > 1 else rows for rows in (target, incoming))
        mine = [b for b in touched if b % passes == k]
        if touched:
            if not mine:
                continue
            files = [known[b] for b in mine if b in known]
            old = layers.read_paths(files, whole.schema) if files else whole.limit(0)
        merged = _merged(old, before, new, offered, keys, stamps).withColumn(BUCKET, bucket)
        # Large buckets are split over tasks, small ones share one.
        merged.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)
        if passes > 1:
            del merged
            release(layers.spark)
        if stepwise and k < passes - 1:
            held_now.update({b: f"{path}/{BUCKET}={b}" for b in mine})
            layers.publish({(layer, table): list(held_now.values())}, at)
    result = layers.read_path(path)
    new = {b: f"{path}/{BUCKET}={b}" for b in touched or _numbers(result)}
    kept = [p for b, p in known.items() if b not in new] if touched else []
    inserted = result.count() - before
    return Upserted([*kept, *new.values()], list(new.values()), inserted, offered - inserted)
