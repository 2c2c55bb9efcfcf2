"""Enrichment and absence joins.

No hint is given: dimensions are written tables whose file size Spark knows,
so it broadcasts the small ones and sorts or splits the rest at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import folded
from terrace.session import written


def enriched(
    df: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    fold: bool = False,
) -> DataFrame:
    """Left join bringing renamed columns of a lookup.

    ``on`` maps a column of ``df`` to its counterpart, ``take`` a lookup
    column to the name it gets. With ``fold`` text keys match regardless of
    case and trailing blanks.
    """
    side = lookup.select(
        *[F.col(there).alias(f"_k_{i}") for i, there in enumerate(on.values())],
        *[F.col(c).alias(name) for c, name in take.items()],
    )
    test: Column = F.lit(True)
    for i, here in enumerate(on):
        a, b = df[here], side[f"_k_{i}"]
        test &= folded(a) == folded(b) if fold else a == b
    return df.join(side, test, "left").drop(*[f"_k_{i}" for i in range(len(on))])


def without_match(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows with no counterpart, also when the key is NULL (NOT EXISTS)."""
    side = other.select(*[F.col(there).alias(f"_k_{i}") for i, there in enumerate(on.values())])
    test: Column = F.lit(True)
    for i, here in enumerate(on):
        test &= df[here] == side[f"_k_{i}"]
    return df.join(side, test, "left_anti")


def key_combinations(fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each combination of keys that occurs, with its number of rows. Written: the fact is scanned once, for these columns."""
    counted = fact.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    return written(counted, "key-combinations")


def with_known(combinations: DataFrame, dimensions: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Add ``_known_0``, ``_known_1``, ...: whether the dimension holds the key.

    ``combinations`` should be few and written. A NULL key is in no dimension; such
    rows do not take part in the join, where they would all meet in one task.
    """
    rows = combinations
    for i, (column, dimension, key) in enumerate(dimensions):
        side = dimension.select(F.col(key).alias("_k")).distinct()
        present = rows.where(F.col(column).isNotNull()).join(side, F.col(column) == F.col("_k"), "left")
        present = present.withColumn(f"_known_{i}", F.col("_k").isNotNull()).drop("_k")
        rows = present.unionByName(rows.where(F.col(column).isNull()).withColumn(f"_known_{i}", F.lit(False)))
    return rows


def unconnected(
    fact: DataFrame, dimensions: Sequence[tuple[str, DataFrame, str]]
) -> DataFrame:
    """Fact rows lacking a counterpart in at least one dimension.

    Each dimension is given as (fact column, dimension, key). Rows with a NULL
    key lack one and need no join. Of the others only distinct key combinations are
    judged; whole rows meet those found wanting.
    """
    columns = list(dict.fromkeys(c for c, _, _ in dimensions))
    missing = reduce(or_, [F.col(c).isNull() for c in columns])
    judged = with_known(key_combinations(fact.where(~missing), columns), dimensions)
    known = reduce(and_, [F.col(f"_known_{i}") for i in range(len(dimensions))])
    wanting = judged.where(~known).select(*columns)
    found = fact.where(~missing).join(wanting, columns, "left_semi").select(*fact.columns)
    return fact.where(missing).unionByName(found)
