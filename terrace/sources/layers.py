"""Layer tables as Parquet versions behind one manifest.

A load never changes files that readers may be using: each table is written
to a fresh directory, and one appended manifest line switches every table of
the step at once. A failed step leaves the manifest, and so all readers, on
the previous state. A version may consist of several directories, of which a
later one keeps those it did not change. One writer per warehouse is assumed.
Directories that a version no longer has are kept for readers of older ones, unless told otherwise.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from terrace.operators.conform import conformed, empty, missing_required, relaxed
from terrace.session import dropped

_MANIFEST = "sequence bigint, published_at timestamp, tables map<string,array<string>>, schemas map<string,string>"


class Layers:
    def __init__(self, spark: SparkSession, root: str, prefix: str = "", keep_old: bool = True):
        """``prefix`` is put before the names of the layers' databases.

        Without ``keep_old`` a publish deletes the directories of the versions it
        replaces; whoever still reads one of them fails.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.keep_old = keep_old
        self._known: tuple[int, dict[str, list[str]], dict[str, str]] | None = None
        self._followed: set[str] = set()
        self._publishing = Lock()

    # -- manifest ---------------------------------------------------------
    def refresh(self) -> None:
        """Look at the manifest again; needed when another session published."""
        self._known = None

    def _state(self) -> tuple[int, dict[str, list[str]], dict[str, str]]:
        if self._known is None:
            self._known = self._last_line()
        return self._known

    def _last_line(self) -> tuple[int, dict[str, list[str]], dict[str, str]]:
        """Sequence, paths and declared schemas in force; one small row reaches the driver."""
        try:
            log = self.spark.read.schema(_MANIFEST).json(f"{self.root}/_manifest")
            last = log.agg(F.max_by(F.struct("sequence", "tables", "schemas"), "sequence").alias("m")).first()["m"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            last = None
        return (last["sequence"], dict(last["tables"]), dict(last["schemas"] or {})) if last else (0, {}, {})

    def publish(
        self,
        paths: Mapping[tuple[str, str], str | Sequence[str]],
        at: datetime,
        schemas: Mapping[tuple[str, str], StructType] | None = None,
    ) -> int:
        """Switch the given tables to their new versions, all at once; registered views follow.

        A table keeps the schema it was declared with, unless ``schemas`` has another.
        """
        with self._publishing:
            sequence, before, declared = self._state()
            tables, declared = dict(before), dict(declared)
            tables.update({f"{layer}.{table}": [p] if isinstance(p, str) else list(p) for (layer, table), p in paths.items()})
            declared.update({f"{layer}.{table}": s.json() for (layer, table), s in (schemas or {}).items()})
            line = self.spark.createDataFrame([(sequence + 1, at, tables, declared)], _MANIFEST).coalesce(1)
            line.write.mode("append").json(f"{self.root}/_manifest")
            self._known = (sequence + 1, tables, declared)
        for layer, table in paths:
            if layer in self._followed:
                self._point(layer, table)
        if not self.keep_old:
            self._drop_replaced([before.get(f"{layer}.{table}", []) for layer, table in paths], tables)
        return sequence + 1

    def _drop_replaced(self, old: Sequence[list[str]], tables: Mapping[str, list[str]]) -> None:
        """Delete listed directories that are not, and do not hold, one of a table in force."""
        inside = {p for paths in tables.values() for p in paths}
        for path in (p for paths in old for p in paths):
            if path.startswith(f"{self.root}/") and not any(p == path or p.startswith(f"{path}/") for p in inside):
                dropped(self.spark, path)

    # -- tables -----------------------------------------------------------
    def new_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}/v-{uuid.uuid4().hex}"

    def write(self, layer: str, table: str, df: DataFrame) -> str:
        """Write a new, not yet published version and return its path."""
        path = self.new_path(layer, table)
        df.write.parquet(path)
        return path

    def exists(self, layer: str, table: str) -> bool:
        return f"{layer}.{table}" in self._state()[1]

    def paths(self, layer: str, table: str) -> list[str]:
        """The directories of the version in force."""
        found = self._state()[1].get(f"{layer}.{table}")
        if found is None:
            raise KeyError(f"table {layer}.{table} was never published")
        return found

    def schema(self, layer: str, table: str) -> StructType | None:
        """The schema a table was declared with, if it was; NULL where columns may be."""
        told = self._state()[2].get(f"{layer}.{table}")
        return StructType.fromJson(json.loads(told)) if told else None

    def read(self, layer: str, table: str) -> DataFrame:
        """A table in its declared schema; a column that older files lack is NULL there."""
        return self.read_paths(self.paths(layer, table), self.schema(layer, table))

    def read_paths(self, paths: Sequence[str], schema: StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*paths)

    def read_path(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def tables(self, layer: str | None = None) -> list[tuple[str, str]]:
        names = [tuple(name.split(".", 1)) for name in self._state()[1]]
        return sorted(n for n in names if layer in (None, n[0]))

    def replace(self, layer: str, table: str, df: DataFrame, at: datetime) -> None:
        """Materialise a query as the new content of a table, whose columns are from now on those of the query."""
        with_schema = {(layer, table): relaxed(df.schema)} if self.schema(layer, table) is not None else None
        self.publish({(layer, table): self.write(layer, table, df)}, at, with_schema)

    def insert(self, layer: str, table: str, df: DataFrame, at: datetime) -> None:
        """Append rows that fit the declared schema; a NULL in a column that must not have one fails the load.

        What is there already is not touched: the new version has one more directory.
        """
        schema = self.schema(layer, table)
        if schema is None:
            raise ValueError(f"table {layer}.{table} was not declared")
        refused = F.raise_error(F.lit(f"a required column of {layer}.{table} is missing")).cast("boolean")
        rows = conformed(df, schema)
        path = self.write(layer, table, rows.where(F.when(missing_required(schema), refused).otherwise(True)))
        self.publish({(layer, table): [*self.paths(layer, table), path]}, at)

    def create_if_absent(self, schemas: Mapping[tuple[str, str], StructType], at: datetime) -> list[tuple[str, str]]:
        """Publish empty tables for the names that do not exist yet."""
        known = set(self._state()[1])
        new = {k: s for k, s in schemas.items() if ".".join(k) not in known}
        if new:
            self.recreate(new, at)
        return sorted(new)

    def recreate(self, schemas: Mapping[tuple[str, str], StructType], at: datetime) -> None:
        """Publish empty tables, whatever was there before."""
        paths = {k: self.write(*k, empty(self.spark, s)) for k, s in schemas.items()}
        self.publish(paths, at, schemas)

    def relax(self, layer: str, table: str, columns: Sequence[str], at: datetime) -> None:
        """Let rows come without these columns from now on. Only the declaration changes, files stay as they are."""
        schema = self.schema(layer, table)
        if schema is None:
            raise ValueError(f"table {layer}.{table} was not declared")
        self.publish({}, at, {(layer, table): relaxed(schema, columns)})

    def add_columns(self, layer: str, table: str, fields: Sequence[StructField], at: datetime) -> None:
        """Declare further columns, which may be NULL; rows that are there have NULL in them."""
        schema = self.schema(layer, table)
        if schema is None:
            raise ValueError(f"table {layer}.{table} was not declared")
        self.publish({}, at, {(layer, table): StructType([*schema.fields, *relaxed(StructType(list(fields))).fields])})

    # -- names ------------------------------------------------------------
    def expose(self, layer: str) -> None:
        """Make a layer's tables readable as temporary views ``layer_table``."""
        for name, table in self.tables(layer):
            self.read(name, table).createOrReplaceTempView(f"{name}_{table}")

    def define_view(self, name: str, query: DataFrame) -> None:
        query.createOrReplaceTempView(name)

    def create_databases(self, layers: tuple[str, ...]) -> None:
        """One catalog database per layer, created when absent.

        Its own folder holds no data: dropping a database must not delete the
        layer's files.
        """
        for layer in layers:
            folder = f"{self.root}/_catalog/{layer}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{layer}` LOCATION '{folder}'")

    def register(self, layer: str) -> None:
        """Make a layer's tables readable as views of its database, which follow every later publish of this session."""
        self._followed.add(layer)
        for name, table in self.tables(layer):
            self._point(name, table)

    def _point(self, layer: str, table: str) -> None:
        """Readers of the view see the old version or the new one; it is never absent."""
        every = " UNION ALL ".join(f"SELECT * FROM parquet.`{p}`" for p in self.paths(layer, table))
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self.prefix}{layer}`.`{table}` AS {every}")

    def define_view_in(self, layer: str, name: str, query: str) -> None:
        """Keep a query over registered views as a view of a layer's database; nothing is stored."""
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self.prefix}{layer}`.`{name}` AS {query}")
