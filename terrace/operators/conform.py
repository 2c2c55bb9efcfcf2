"""Bring a DataFrame into a declared schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

_LENGTH = "max_length"


def field(name: str, dtype: DataType, nullable: bool = True, length: int | None = None) -> StructField:
    return StructField(name, dtype, nullable, {_LENGTH: length} if length else {})


def varchar(name: str, length: int, nullable: bool = True) -> StructField:
    return field(name, StringType(), nullable, length)


def conformed(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in order and type; nothing is cut or lost.

    A column the input lacks becomes NULL; one the schema lacks is dropped. A
    text longer than declared, or a value that does not fit the declared type, fails the job: to
    shorten or to convert tolerantly is the model's business, not the table's.
    """
    columns: list[Column] = []
    for f in schema:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name not in df.columns or df.schema[f.name].dataType != f.dataType:
            value = value.cast(f.dataType)
        if _LENGTH in f.metadata:
            most = f.metadata[_LENGTH]
            refused = F.raise_error(F.lit(f"{f.name} is longer than {most} characters"))
            value = F.when(F.length(value) > most, refused.cast("string")).otherwise(value)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def missing_required(schema: StructType) -> Column:
    """Test of one row: some NOT NULL column of the schema is NULL."""
    test = F.lit(False)
    for f in schema:
        if not f.nullable:
            test |= F.col(f.name).isNull()
    return test


def unbounded(schema: StructType) -> StructType:
    """The schema with texts of any length."""
    return StructType([StructField(f.name, f.dataType, f.nullable, {k: v for k, v in f.metadata.items() if k != _LENGTH}) for f in schema])


def relaxed(schema: StructType, columns: Sequence[str] | None = None) -> StructType:
    """The schema with the given columns (default all) made nullable."""
    return StructType(
        [
            StructField(
                f.name,
                f.dataType,
                True if columns is None or f.name in columns else f.nullable,
                f.metadata,
            )
            for f in schema
        ]
    )


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Add the columns the input lacks; values are fixed once, never per row."""
    absent = {c: v for c, v in defaults.items() if c not in df.columns}
    return df.withColumns({c: v if isinstance(v, Column) else F.lit(v) for c, v in absent.items()})


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], relaxed(schema))
