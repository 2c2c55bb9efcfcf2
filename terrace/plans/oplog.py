"""Run bookkeeping as data: jobs, tasks, files, checks, counts, alerts.

Every table is append-only Parquet. Start and end of a run are two rows with
one id; the current state is the later one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from decimal import Decimal
from threading import Lock
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.conform import empty, relaxed
from terrace.operators.dedup import keep_one
from terrace.schemas import OPS, RUN_STATES, SEVERITIES


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


class RunLog:
    def __init__(self, spark: SparkSession, root: str, clock: Callable[[], datetime] = utc_now):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/ops"
        self.clock = clock
        self._started: dict[str, dict[str, Any]] = {}
        self._appending = Lock()  # of two jobs that append to a folder the first to end clears the other's unfinished files

    def append(self, table: str, rows: DataFrame) -> None:
        with self._appending:
            rows.write.mode("append").parquet(f"{self.root}/{table}")

    def _append_one(self, table: str, values: Mapping[str, Any]) -> None:
        schema = OPS[table]
        for f in schema:
            if not f.nullable and values.get(f.name) is None:
                raise ValueError(f"{table}.{f.name} is required")
        row = [tuple(values.get(name) for name in schema.names)]
        self.append(table, self.spark.createDataFrame(row, relaxed(schema)).coalesce(1))

    def read(self, table: str) -> DataFrame:
        """All rows of a log table; one nobody has written to yet is empty."""
        try:
            return self.spark.read.schema(relaxed(OPS[table])).parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty(self.spark, OPS[table])

    # -- runs -------------------------------------------------------------
    def start_job(self, name: str) -> str:
        job = str(uuid.uuid4())
        values = {
            "job_run_id": job, "pipeline_name": name, "pl_status": "Running",
            "started_at": self.clock(), "status_message": f"{name}: under way",
        }
        self._started[job] = values
        self._append_one("job_runs", values)
        return job

    def finish_job(self, job: str, status: str, message: str) -> None:
        self._append_one("job_runs", self._ended("job_runs", job, "pl_status", status, message))

    def start_task(self, job: str, name: str) -> str:
        task = str(uuid.uuid4())
        values = {
            "task_run_id": task, "job_run_id": job, "task_name": name,
            "task_status": "Running", "started_at": self.clock(),
        }
        self._started[task] = values
        self._append_one("task_runs", values)
        return task

    def finish_task(self, task: str, status: str, message: str, **counts: int | None) -> None:
        self._append_one("task_runs", {**self._ended("task_runs", task, "task_status", status, message), **counts})

    def _begun(self, table: str, run: str) -> dict[str, Any]:
        """The row a run began with, from the log where another process began it."""
        if run not in self._started:
            key = OPS[table].names[0]
            found = self.read(table).where(F.col(key) == run).orderBy(F.col("ended_at").asc_nulls_first()).first()
            if found is None:
                raise KeyError(f"{table} has no run {run}")
            self._started[run] = found.asDict() | {"started_at": found.started_at.astimezone(timezone.utc)}
        return self._started[run]

    def _ended(self, table: str, run: str, state: str, status: str, message: str) -> dict[str, Any]:
        if status not in RUN_STATES:
            raise ValueError(f"unknown status {status!r}")
        begun = self._begun(table, run)
        end = self.clock()
        millis = (end - begun["started_at"]).total_seconds() * 1000
        return {
            **begun, state: status, "ended_at": end,
            "duration_sec": Decimal(int(millis)) / 1000, "status_message": message,
        }

    def job_runs(self) -> DataFrame:
        return self._latest("job_runs", "job_run_id")

    def task_runs(self) -> DataFrame:
        return self._latest("task_runs", "task_run_id")

    def unfinished(self, name: str) -> str | None:
        """The last run of a pipeline, if it has not ended well."""
        last = self.job_runs().where(F.col("pipeline_name") == name).orderBy(F.desc("started_at"), "job_run_id").first()
        return last.job_run_id if last and last.pl_status != "Success" else None

    def succeeded(self, job: str) -> set[str]:
        """Names of a run's tasks that are done."""
        done = self.task_runs().where((F.col("job_run_id") == job) & (F.col("task_status") == "Success"))
        return {r.task_name for r in done.select("task_name").collect()}

    def new_files(self, listed: DataFrame, source: str) -> DataFrame:
        """Of listed files (see ``file_facts``) those no load of the source has recorded as they are now."""
        same = ["source_file", "file_size_bytes", "file_modified_at"]
        loaded = self.read("source_file_audit").where(F.col("source_name") == source).select(*same)
        return listed.join(loaded, same, "left_anti")

    def _latest(self, table: str, key: str) -> DataFrame:
        return keep_one(self.read(table), [key], [F.col("ended_at").desc_nulls_last()])

    # -- results ----------------------------------------------------------
    def _stamped(self, table: str, rows: DataFrame, **more: Column) -> DataFrame:
        """Rows with an id made of the call's own and what the row holds, so that a task run again gives the same.

        Rows of one call that are equal in every column share an id.
        """
        key = OPS[table].names[0]
        digest = F.md5(F.concat(F.lit(uuid.uuid4().hex), F.to_json(F.struct("*"))))
        parts = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        named = {key: F.concat_ws("-", *parts), **more}
        complete = rows.withColumns(named)
        return complete.select(
            *[
                (F.col(f.name) if f.name in complete.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in OPS[table]
            ]
        )

    def record_files(self, job: str, audit: DataFrame) -> None:
        self.append("source_file_audit", self._stamped("source_file_audit", audit, job_run_id=F.lit(job)))

    def record_checks(self, job: str | None, summary: DataFrame) -> None:
        at = F.lit(self.clock()).cast("timestamp")
        rows = self._stamped("data_quality_results", summary, job_run_id=F.lit(job), checked_at=at)
        self.append("data_quality_results", rows.coalesce(1))

    def record_counts(self, job: str | None, counts: DataFrame) -> None:
        at = F.lit(self.clock()).cast("timestamp")
        rows = self._stamped("table_row_counts", counts, job_run_id=F.lit(job), captured_at=at)
        self.append("table_row_counts", rows.coalesce(1))

    def alert(self, job: str | None, severity: str, subject: str, message: str, channel: str = "job") -> None:
        if severity not in SEVERITIES:
            raise ValueError(f"unknown severity {severity!r}")
        self._append_one(
            "alerts",
            {
                "alert_id": str(uuid.uuid4()), "job_run_id": job, "severity": severity,
                "channel": channel, "alert_subject": subject, "alert_message": message,
                "created_at": self.clock(),
            },
        )
