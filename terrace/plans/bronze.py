"""Bronze load of one delivered source: scan, stage by verdict, one row per key, upsert into the buckets it touches."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import is_present
from terrace.operators.conform import conformed, relaxed
from terrace.operators.dedup import (
    keep_last_in_file,
    keep_latest_date,
    keep_one,
    where_repeated,
    with_keys_present,
)
from terrace.schemas import LINEAGE_COLUMNS, Source, raw_schema, typed_schema
from terrace.session import scratch
from terrace.sources.buckets import upsert_buckets
from terrace.sources.files import MALFORMED, WRONG_WIDTH, file_facts, scan_by_name, scan_typed, with_lineage, with_row_numbers
from terrace.sources.layers import Layers


# A staged line's verdict; each has a folder of its own in the staging table.
VERDICT = "verdict"
GOOD, NO_KEY, MALFORMED_LINE = "good", "no_key", "malformed"


@dataclass(frozen=True)
class LoadCounts:
    read: int
    inserted: int
    updated: int
    rejected: int  # lines without a key
    malformed: int = 0  # other lines of wrong width, or with a value that cannot be read


@dataclass(frozen=True)
class Loaded:
    """A published load: its counts, the audit rows of its files, and the rows of the buckets it wrote."""

    counts: LoadCounts
    audit: DataFrame
    rewritten: DataFrame


def one_row_per_key(staged: DataFrame, source: Source, blank_keys: str = "reject", prefer: str = "last_row") -> DataFrame:
    """Rows with a key, one each.

    ``prefer``: ``last_row`` of the file, ``latest_date`` by the source's
    date (sources without one: last row), ``any`` by all columns.
    """
    keyed = with_keys_present(staged, source.keys, blank_is_missing=blank_keys == "reject")
    if prefer == "any":
        choose = partial(keep_one, keys=source.keys)
    elif prefer == "latest_date" and source.latest_by:
        choose = partial(keep_latest_date, keys=source.keys, date=source.latest_by)
    else:
        choose = partial(keep_last_in_file, keys=source.keys)
    return where_repeated(keyed, source.keys, choose)


def _apart(layers: Layers, source: Source, rows: DataFrame) -> tuple[str, dict[str, int]]:
    """Write lines into a fresh staging version, a folder for each verdict, in one pass; and how many each has."""
    path = layers.new_path("staging", source.name)
    rows.write.partitionBy(VERDICT).parquet(path)
    counted = layers.read_paths([path], rows.schema).groupBy(VERDICT).count()
    counts = {r[VERDICT]: r["count"] for r in counted.collect()}  # from footers, at most three rows
    if not counts:
        path = layers.write("staging", source.name, rows.limit(0))
    return path, counts


def stage(
    layers: Layers, source: Source, path: str, batch_id: str, loaded_at: datetime, keep_blank: bool = True,
    multiline: bool = False, blank_keys: str = "reject",
) -> tuple[str, dict[str, int]]:
    """Scan the files into a fresh staging version; its path, and the number of lines of each verdict."""
    scan = scan_by_name(layers.spark, path, source.columns, keep_blank=keep_blank, multiline=multiline)
    keyed = F.lit(True)
    for key in source.keys:
        keyed &= is_present(F.col(key)) if blank_keys == "reject" else F.col(key).isNotNull()
    verdict = F.when(~keyed, NO_KEY).when(F.col(WRONG_WIDTH), MALFORMED_LINE).otherwise(GOOD)
    rows = with_lineage(scan, source.columns, batch_id, loaded_at).withColumn(VERDICT, verdict)
    return _apart(layers, source, rows.drop(WRONG_WIDTH))


def load_source(
    layers: Layers,
    source: Source,
    path: str,
    batch_id: str,
    loaded_at: datetime,
    blank_keys: str = "reject",
    prefer: str = "last_row",
    lineage: bool = True,
    keep_blank: bool = True,
    multiline: bool = False,
    malformed: str = "load",
    buckets: int | None = None,
) -> Loaded:
    """Upsert the delivered files into bronze and publish the new version.

    Lines without a key are rejected. Those with a wrong number of fields are
    loaded as far as they go, or with ``malformed="quarantine"`` stay in staging. In either
    case staging holds them apart, with the line as delivered (``quarantined``). Without ``lineage``
    the metadata columns stay NULL, which needs the relaxed schema. Empty
    fields are empty text, or NULL without ``keep_blank``. With
    ``multiline`` quoted fields may hold line breaks. Only the buckets of keys that the
    delivery touches are rewritten; their number follows the table unless given. Where replaced
    versions are not kept, staging is emptied first, and stays empty if the load fails; buckets are then
    published pass by pass (see ``upsert_buckets``).
    """
    if not layers.keep_old and layers.exists("staging", source.name):
        nothing = layers.write("staging", source.name, layers.read("staging", source.name).limit(0))
        layers.publish({("staging", source.name): nothing}, loaded_at)
    staged_path, lines = stage(layers, source, path, batch_id, loaded_at, keep_blank, multiline, blank_keys)
    staged = with_row_numbers(layers.read_path(staged_path))
    admitted = [GOOD] if malformed == "quarantine" else [GOOD, MALFORMED_LINE]
    delivered = staged.where(F.col(VERDICT).isin(admitted)).drop(VERDICT, MALFORMED)
    with scratch(layers.spark):
        picked = one_row_per_key(delivered, source, blank_keys, prefer)
        if not lineage:
            picked = picked.drop(*LINEAGE_COLUMNS)
        # Staged rows that need no choice are read again where they lie; there is no copy of them.
        incoming = conformed(picked, relaxed(raw_schema(source)))
        merged = upsert_buckets(layers, "bronze", source.name, incoming, source.keys, buckets, at=loaded_at)
    layers.publish({("staging", source.name): staged_path, ("bronze", source.name): merged.paths}, loaded_at)
    counts = LoadCounts(
        sum(lines.values()), merged.inserted, merged.updated, lines.get(NO_KEY, 0), lines.get(MALFORMED_LINE, 0)
    )
    table = layers.read("bronze", source.name)
    touched = layers.read_paths(merged.rewritten, table.schema) if merged.rewritten else table.limit(0)
    return Loaded(counts, audited_files(layers, source, path, staged, loaded_at), touched)


def replace_source(
    layers: Layers, source: Source, path: str, loaded_at: datetime, tolerate: bool = False, malformed: str = "load",
    multiline: bool = False,
) -> Loaded:
    """Load the delivered files typed, replacing the bronze table.

    A value of the wrong type fails the load, or is NULL when tolerated. With
    ``malformed="quarantine"`` the lines that hold one stay in staging. One pass writes
    lines apart by verdict; the bronze table is the folders it admits.
    """
    apart = malformed == "quarantine"
    rows = scan_typed(layers.spark, path, typed_schema(source), tolerate=tolerate or apart, multiline=multiline)
    line = F.col(MALFORMED) if tolerate or apart else F.lit(None).cast("string")
    verdict = F.when(line.isNull(), GOOD).otherwise(MALFORMED_LINE)
    origin = F.col("_metadata.file_path").alias("source_file")
    staged_path, lines = _apart(layers, source, rows.select(*source.columns, origin, line.alias(MALFORMED), verdict.alias(VERDICT)))
    admitted = [v for v in ([GOOD] if apart else [GOOD, MALFORMED_LINE]) if v in lines]
    staged = layers.read_path(staged_path)
    bronze = [f"{staged_path}/{VERDICT}={v}" for v in admitted]
    bronze = bronze or [layers.write("bronze", source.name, staged.limit(0).drop(VERDICT))]
    layers.publish({("staging", source.name): staged_path, ("bronze", source.name): bronze}, loaded_at)
    n = sum(lines[v] for v in admitted)
    counts = LoadCounts(sum(lines.values()), n, 0, 0, lines.get(MALFORMED_LINE, 0))
    return Loaded(counts, audited_files(layers, source, path, staged, loaded_at), layers.read("bronze", source.name))


def quarantined(layers: Layers, source: Source) -> DataFrame:
    """Lines of the last delivery that are not as declared: verdict, the line as delivered, its file, and what could be read."""
    held = layers.read("staging", source.name).where(F.col(VERDICT) != GOOD)
    return held.select(VERDICT, F.col(MALFORMED).alias("line"), "source_file", *source.columns)


def audited_files(layers: Layers, source: Source, path: str, loaded: DataFrame, loaded_at: datetime) -> DataFrame:
    """Facts and row count of each delivered file, also of one with a header only."""
    rows = loaded.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"))
    return (
        file_facts(layers.spark, path)
        .join(rows, "source_file", "left")
        .select(
            F.lit(source.name).alias("source_name"),
            "source_file",
            "file_size_bytes",
            F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
            "file_modified_at",
            F.lit(loaded_at).cast("timestamp").alias("loaded_at"),
        )
    )
