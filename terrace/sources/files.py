"""CSV scans and exports.

Files are split and read in parallel. Row numbers come from the position in
each split plus the rows of earlier splits, never from one reader.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from terrace.functions.text import row_digest

MALFORMED = "_malformed_line"
WRONG_WIDTH = "wrong_width"

# A quote inside a quoted field is doubled, as RFC 4180 and spreadsheets have it.
QUOTING = {"quote": '"', "escape": '"'}


def scan_by_name(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    keep_blank: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Text columns picked by header name.

    A column the file lacks is the empty string. An empty field reads as NULL,
    or as the empty string with ``keep_blank``; in a line with the wrong
    number of fields the missing ones stay NULL, ``wrong_width`` is true and
    ``_malformed_line`` holds the line.
    Every file under the path must carry the same header. A quoted field may
    hold line breaks only with ``multiline``, which reads each file in one task.
    """
    options = {"header": True, "multiLine": multiline, **QUOTING}
    header = spark.read.options(**options).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in [*header, MALFORMED]])
    raw = (
        spark.read.options(
            **options, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED
        )
        .schema(schema)
        .csv(path)
    )
    chosen = []
    for c in columns:
        if c not in header:
            value = F.lit("")
        elif keep_blank:
            value = F.when(F.col(MALFORMED).isNull(), F.coalesce(_named(c), F.lit(""))).otherwise(_named(c))
        else:
            value = _named(c)
        chosen.append(value.alias(c))
    return raw.select(*chosen, F.col(MALFORMED).isNotNull().alias(WRONG_WIDTH), MALFORMED, *_origin())


def _named(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def scan_by_position(spark: SparkSession, path: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """Declared columns matched by position; the header line is skipped."""
    raw = spark.read.options(header=True, enforceSchema=True, multiLine=multiline, **QUOTING).schema(schema).csv(path)
    return raw.select("*", *_origin())


def scan_typed(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    separator: str = ",",
    tolerate: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Declared types; a bad value fails the load unless tolerated.

    When tolerated the value is NULL and the line is kept in
    ``_malformed_line``.
    """
    reader = spark.read.options(header=True, sep=separator, multiLine=multiline, **QUOTING)
    if tolerate:
        kept = StructType([*schema.fields, StructField(MALFORMED, StringType())])
        return (
            reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED)
            .schema(kept)
            .csv(path)
        )
    return reader.option("mode", "FAILFAST").schema(schema).csv(path)


def _origin() -> list:
    return [
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_modified_at"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    ]


def with_lineage(scan: DataFrame, columns: Sequence[str], batch_id: str, loaded_at: datetime) -> DataFrame:
    """Add batch, load time and row digest; one batch has one load time."""
    return scan.withColumns(
        {
            "batch_id": F.lit(batch_id),
            "loaded_at": F.lit(loaded_at).cast("timestamp"),
            "row_hash": row_digest([F.col(c) for c in columns]),
        }
    )


def with_row_numbers(staged: DataFrame, name: str = "source_row_number") -> DataFrame:
    """Replace the scan position by the row number within each file, from 1.

    ``staged`` must be written first: positions belong to one scan. The table
    of offsets has one row per split and is sent to every task: the staged rows are not shuffled.
    """
    splits = staged.groupBy("source_file", "_block").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    number = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return (
        staged.join(F.broadcast(offsets), ["source_file", "_block"])
        .withColumn(name, number.cast("bigint"))
        .select(*[c for c in staged.columns if c not in ("_block", "_at")], name)
    )


def file_facts(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """Path, size and modification time of each file, with ``recursive`` at any depth; contents are not read.

    Spark lists the path, many folders in parallel. It plans no scan of a file of
    zero bytes, so of the listed files those without a row are asked for their
    time one by one: empty deliveries only. Paths are written as scans write them.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    filled = listed.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("file_size_bytes"),
        F.col("_metadata.file_modification_time").alias("file_modified_at"),
    )
    # The listing writes local paths with three slashes, a scan with one.
    names = spark.createDataFrame([(re.sub("^file:/+", "file:/", name),) for name in listed.inputFiles()], "source_file string")
    empty = []
    for row in names.join(filled, "source_file", "left_anti").collect():
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row.source_file))
        status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
        empty.append((row.source_file, status.getLen(), status.getModificationTime()))
    if not empty:
        return filled
    rows = spark.createDataFrame(empty, "source_file string, file_size_bytes bigint, at bigint")
    return filled.unionByName(rows.select("source_file", "file_size_bytes", F.timestamp_millis("at").alias("file_modified_at")))


def export_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with header and CRLF line ends, one file per partition; a compressed file is read by one task.

    The writer would strip blanks by default; values are written unchanged,
    with quotes inside them doubled. Gzip takes its fastest level.
    """
    df.write.options(
        **QUOTING,
        header=True,
        lineSep="\r\n",
        compression=compression,
        **{"zlib.compress.level": "BEST_SPEED"},
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
