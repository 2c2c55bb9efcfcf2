"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. They are SQL settings, so they can be applied to
# a session somebody else has built; sizes of the cluster are left alone.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Tables of numbers and short codes are many times larger in memory than in their files; taken by its
    # files, a dimension of millions of rows would be collected on the driver and sent to every task.
    "spark.sql.sources.fileCompressionFactor": "16",
}


def configured(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session or its context names it.

    A session on one machine that names none gets a temporary folder, kept for
    the life of the process. On a cluster that would be another folder on each
    machine and lose rows, so there it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="terrace-"))
    return _own_folder[0]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


# The paths that `written` has filled within the innermost `scratch`.
_paths: ContextVar[list[str] | None] = ContextVar("paths", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was `written` inside, also by `concurrently`; no DataFrame made of it may be read later."""
    paths: list[str] = []
    outer = _paths.set(paths)
    try:
        yield
    finally:
        _paths.reset(outer)
        for path in paths:
            dropped(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    Cuts lineage and fixes the row placement: everything computed from the
    result sees the same rows, also after an executor was lost. Columnar, so
    a later pass over one column does not read the others.
    """
    path = fresh_path(df.sparkSession, label)
    if (paths := _paths.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder that nobody reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are over.

    It does so when the driver's objects for them are collected, which a driver
    with little garbage of its own would not come to before the disks are full.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def concurrently(spark: SparkSession, calls: Sequence[Callable[[], Any]], threads: int = 4) -> list[Any]:
    """Submit independent Spark jobs from several driver threads.

    Small tables then do not leave the cluster idle one after the other. The
    first failure is raised once all calls have ended.
    """
    with ThreadPoolExecutor(max_workers=threads) as pool:
        pending = [pool.submit(copy_context().run, inheritable_thread_target(spark)(call)) for call in calls]
    return [p.result() for p in pending]
