"""The daily run: bronze, silver, gold, row counts; stops at the first failure."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.operators import quality as q
from terrace.operators.conform import conformed, relaxed, unbounded
from terrace.operators.upsert import upsert
from terrace.plans import gold, rules, silver
from terrace.plans.bronze import LoadCounts, Loaded, load_source, replace_source
from terrace.plans.oplog import RunLog, utc_now
from terrace.plans.presets import INCREMENTAL, Preset
from terrace.schemas import GOLD, LAYERS, SILVER, SOURCES, Source, raw_schema
from terrace.session import concurrently, release, scratch
from terrace.sources.files import file_facts
from terrace.sources.layers import Layers

TABLES = (
    [("bronze", s.name) for s in SOURCES]
    + [("silver", s.name) for s in SOURCES]
    + [("gold", name) for name in GOLD]
)


class CheckFailed(Exception):
    """A constraint does not hold; the step was not published."""


@dataclass
class Warehouse:
    """Where the tables live and how they are built.

    ``malformed`` lines are loaded as far as they go, or left in staging with
    "quarantine". ``multiline`` admits line breaks in quoted fields. ``buckets`` is the number
    of parts in which an upserted bronze table is rewritten; it follows the table unless given.
    Empty fields are empty text, or NULL with ``empty_is_null`` and in typed deliveries.
    Replaced versions of tables are kept for their readers, or deleted without ``keep_old``.
    """

    spark: SparkSession
    root: str
    preset: Preset = INCREMENTAL
    as_of: date | None = None
    blank_keys: str = "reject"
    prefer: str = "last_row"
    tolerate_malformed: bool = False
    malformed: str = "load"
    multiline: bool = False
    lineage: bool = True
    empty_is_null: bool = False
    buckets: int | None = None
    threads: int = 4
    keep_old: bool = True
    clock: Callable[[], datetime] = utc_now

    def __post_init__(self) -> None:
        self.layers = Layers(self.spark, self.root, keep_old=self.keep_old)
        self.log = RunLog(self.spark, self.root, self.clock)

    # -- steps ------------------------------------------------------------
    def set_up(self) -> None:
        """Create the bronze tables that do not exist yet and are not replaced anyway."""
        if self.preset.typed_bronze:
            return
        wanted = {("bronze", s.name): raw_schema(s) for s in SOURCES}
        self.layers.create_if_absent(wanted, self.clock())

    def load_bronze(
        self, paths: Mapping[str, str], sources: Sequence[Source] = SOURCES, resume: str | None = None, only_new: bool = False
    ) -> dict[str, LoadCounts]:
        """Load the sources, several at a time; every table commits on its own.

        ``resume`` names a run that did not end (``RunLog.unfinished``), perhaps of another process: it goes
        on with the tables it has not loaded. With ``only_new`` files are left out that were
        loaded before and have not changed since; upserts make it safe to load one twice.
        """
        batch = str(uuid.uuid4())
        job = resume or self.log.start_job("bronze_load")
        done = self.log.succeeded(job) if resume else set()
        sources = [s for s in sources if f"bronze.{s.name}" not in done]
        calls = [partial(self._load_one, job, batch, source, paths[source.name], only_new) for source in sources]
        try:
            loaded = concurrently(self.spark, calls, self.threads)
        except Exception as error:
            self.log.finish_job(job, "Failed", f"bronze_load: {error}")
            raise
        self.log.finish_job(job, "Success", f"bronze_load: {len(loaded)} sources in place")
        return {source.name: counts for source, counts in zip(sources, loaded)}

    def _load_one(self, job: str, batch: str, source: Source, path: str, only_new: bool) -> LoadCounts:
        name = f"bronze.{source.name}"
        task = self.log.start_task(job, name)
        try:
            if only_new:
                files = self.log.new_files(file_facts(self.spark, path), source.name)
                path = [r.source_file for r in files.select("source_file").collect()]
                if not path:
                    counts = LoadCounts(0, 0, 0, 0)
                    self.log.finish_task(task, "Success", f"{source.name}: no new file", rows_read=0, rows_inserted=0, rows_updated=0, rows_rejected=0)
                    return counts
            with scratch(self.spark):
                result = self._load(source, path, batch)
                self.log.record_files(job, result.audit)
                found = rules.bronze_rules(source.name, typed=self.preset.typed_bronze)
                self._require(job, [checked(name, result.rewritten, [], found)])
        except Exception as error:
            self.log.finish_task(task, "Failed", str(error))
            self.log.alert(job, "Critical", f"Load failure: {name}", str(error))
            raise
        counts = result.counts
        aside = f"; {counts.malformed} malformed lines are in staging" if counts.malformed else ""
        self.log.finish_task(
            task, "Success", f"{source.name}: bronze table is up to date{aside}.", rows_read=counts.read,
            rows_inserted=counts.inserted, rows_updated=counts.updated, rows_rejected=counts.rejected,
        )
        release(self.spark)
        return counts

    def load_silver(self, rebuild: bool = True) -> None:
        """Build all six tables, check them, publish them together.

        A rebuild starts from nothing. Otherwise tables are upserted when the
        preset says so, except the product history, which is always derived
        in full.
        """
        self._step("silver_load", lambda job: self._silver(job, rebuild))

    def load_gold(self) -> None:
        """Build dimensions, then the fact from the written dimensions."""
        self._step("gold_load", self._gold)

    def publish_counts(self) -> DataFrame:
        existing = set(self.layers.tables())
        tables = {k: self.layers.read(*k) for k in TABLES if k in existing}
        counts = q.row_counts(tables)
        self.log.record_counts(None, counts)
        return counts

    def run(self, paths: Mapping[str, str], rebuild_silver: bool = True) -> None:
        self.set_up()
        self.load_bronze(paths)
        self.load_silver(rebuild_silver)
        self.load_gold()
        self.publish_counts()

    # -- inside a step ----------------------------------------------------
    def _load(self, source: Source, path: str | list[str], batch: str) -> Loaded:
        if self.preset.typed_bronze:
            return replace_source(
                self.layers, source, path, self.clock(), self.tolerate_malformed, self.malformed, self.multiline
            )
        return load_source(
            self.layers, source, path, batch, self.clock(), self.blank_keys, self.prefer, self.lineage,
            not (self.preset.typed_delivery or self.empty_is_null), self.multiline, self.malformed, self.buckets,
        )

    def _step(self, name: str, work: Callable[[str], None]) -> None:
        job = self.log.start_job(name)
        try:
            with scratch(self.spark):
                work(job)
        except Exception as error:
            self._failed(job, name, error)
            raise
        self.log.finish_job(job, "Success", f"{name}: tables in place")
        release(self.spark)

    def _failed(self, job: str, where: str, error: Exception) -> None:
        message = str(error)
        self.log.finish_job(job, "Failed", f"Failed at {where}: {message}")
        self.log.alert(job, "Critical", f"Load failure: {where}", message)

    def _declared(self, schema: StructType) -> StructType:
        return relaxed(schema if self.preset.declared_lengths else unbounded(schema))

    def _today(self):
        return F.lit(self.as_of or self.clock().date()).cast("date")

    def _silver(self, job: str, rebuild: bool) -> None:
        stamp, today = F.lit(self.clock()).cast("timestamp"), self._today()
        existing = set(self.layers.tables("silver"))

        def build(source: Source) -> tuple[str, Checked]:
            name = source.name
            model = silver.build(name, self.layers.read("bronze", name), self.preset, today)
            keep = self.preset.upsert_silver and not rebuild and name != "crm_prd_info"
            if keep and ("silver", name) in existing:
                rows = upsert(
                    self.layers.read("silver", name), model, source.keys,
                    stamp=stamp, created="meta_created_at", updated="meta_updated_at",
                )
            else:
                rows = model.withColumns({"meta_created_at": stamp, "meta_updated_at": stamp})
            if not self.preset.typed_delivery:
                rows = conformed(rows, self._declared(SILVER[name]))
            path = self.layers.write("silver", name, rows)
            gates = [] if self.preset.typed_delivery else rules.silver_gates(name)
            others = rules.silver_rules(name, today)
            return path, checked(f"silver.{name}", self.layers.read_path(path), gates, others)

        built = concurrently(self.spark, [partial(build, s) for s in SOURCES], self.threads)
        self._require(job, [result for _, result in built])
        self.layers.publish(
            {("silver", s.name): path for s, (path, _) in zip(SOURCES, built)}, self.clock()
        )

    def _gold(self, job: str) -> None:
        read, stamp, today = self.layers.read, F.lit(self.clock()).cast("timestamp"), self._today()

        def write(name: str, rows: DataFrame) -> str:
            if not self.preset.current_products:
                rows = conformed(rows.withColumn("meta_created_at", stamp), self._declared(GOLD[name]))
            return self.layers.write("gold", name, rows)

        def customers() -> str:
            tables = [read("silver", n) for n in ("crm_cust_info", "erp_cust_az12", "erp_loc_a101")]
            return write("dim_customers", gold.dim_customers(*tables, today, self.preset))

        def products() -> str:
            tables = [read("silver", n) for n in ("crm_prd_info", "erp_px_cat_g1v2")]
            return write("dim_products", gold.dim_products(*tables, self.preset))

        paths = concurrently(self.spark, [customers, products], self.threads)
        dim_customer, dim_product = (self.layers.read_path(p) for p in paths)
        sold = read("silver", "crm_sales_details")
        paths.append(write("fact_sales", gold.fact_sales(sold, dim_product, dim_customer, self.preset)))

        tables = dict(zip(("dim_customers", "dim_products", "fact_sales"), map(self.layers.read_path, paths)))
        has_key = not self.preset.current_products
        plans = []
        for name, df in tables.items():
            gates = rules.gold_gates(name) if has_key or name != "fact_sales" else []
            others = rules.fact_rules(dim_product, dim_customer, sold, has_key) if name == "fact_sales" else []
            plans.append(partial(checked, f"gold.{name}", df, gates, others))
        self._require(job, concurrently(self.spark, plans, self.threads))
        self.layers.publish({("gold", n): p for n, p in zip(tables, paths)}, self.clock())

    def _require(self, job: str, results: list[Checked]) -> None:
        """Record every rule; raise when a gate does not hold."""
        lines = [line for result in results for line in result.lines]
        if lines:
            kinds = "model_name string, test_name string, test_status string, failed_row_count bigint, details string"
            self.log.record_checks(job, self.spark.createDataFrame(lines, kinds))
        broken = [problem for result in results for problem in result.broken_gates]
        if broken:
            raise CheckFailed(", ".join(broken))


@dataclass(frozen=True)
class Checked:
    """Outcome of the rules of one table: a line per rule, and failed gates."""

    lines: list
    broken_gates: list[str]


def checked(model: str, df: DataFrame, gates: Sequence[q.Rule], others: Sequence[q.Rule | q.RuleSet]) -> Checked:
    if not gates and not others:
        return Checked([], [])
    lines = q.summarized(model, df, [*gates, *others]).collect()  # one row per rule
    names = {r.name for r in gates}
    broken = [
        f"{model} {r.test_name}: {r.failed_row_count}"
        for r in lines
        if r.test_name in names and r.failed_row_count > 0
    ]
    return Checked(lines, broken)


__all__ = ["Warehouse", "CheckFailed", "TABLES", "LAYERS"]
