"""Helpers the operators share: cutting lineage, and hashing words of many texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import dropped, fresh_path, release

# Texts are taken in pieces of about this many bytes, so that the working
# arrays of a task stay small whatever an Arrow batch holds.
PIECE_BYTES = 2_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder; Spark removes the files with the last reference."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(fresh_path(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends, columns stay prunable."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    schema = df.schema
    release(df.sparkSession)
    return df.sparkSession.read.schema(schema).parquet(path)


class Scratch:
    """Tables written between the steps of an operator, by label; each is deleted when its last reader has been written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[str, str] = {}

    def put(self, df: DataFrame, label: str) -> DataFrame:
        return self.put_all([df], label)

    def put_all(self, parts: Iterable[DataFrame], label: str) -> DataFrame:
        """One table of all parts; shuffle files of one are gone when the next is written."""
        if label in self._paths:
            raise ValueError(f"{label} is written already")
        self._paths[label] = path = fresh_path(self.spark, label)
        for df in parts:
            df.write.mode("append").parquet(path, compression="zstd")
            schema = df.schema
            del df
            release(self.spark)
        return self.spark.read.schema(schema).parquet(path)

    def rename(self, label: str, other: str) -> None:
        """Know a table, whose files stay where they are, by another label."""
        self._paths[other] = self._paths.pop(label)

    def drop(self, *labels: str) -> None:
        for label in labels:
            dropped(self.spark, self._paths.pop(label))


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


KEY = ["row", "version"]


def keyed(docs: DataFrame) -> DataFrame:
    """Rows known by doc_id and a 128-bit hash of the text; a null id counts as the least number there is, a null text is empty."""
    return docs.select("doc_id", *row_key(), text_or_empty().alias("text"))


def row_key() -> list[Column]:
    row = F.coalesce("doc_id", F.lit(-(1 << 63)))
    return [row.alias("row"), F.unhex(F.md5(text_or_empty().cast("binary"))).alias("version")]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_STEPS: dict[int, np.ndarray] = {}


def _powers_to(base: np.uint64, n: int) -> np.ndarray:
    """Powers of a base, kept between calls and grown by need."""
    known = _STEPS.get(int(base))
    if known is None or len(known) < n:
        known = _STEPS[int(base)] = powers(base, max(n, 1 << 16))
    return known[:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[s:e] for each pair of bounds; equal runs have equal hashes.

    Each value is multiplied by a power of the base; the sum over a run comes
    from prefix sums and is moved to a common power by the inverse base.
    """
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _powers_to(_BASE, n), out=sums[1:])
    run = (sums[ends] - sums[starts]) * _powers_to(_INVERSE, n + 1)[starts]
    return mixed(run + (ends - starts).astype(np.uint64))


_LETTER = np.ones(256, bool)
_LETTER[:128] = [chr(c).isalnum() for c in range(128)]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of several texts: `hash` of each word, `doc` bounds, byte bounds.

    Words are runs of anything but the six white-space bytes of ASCII.
    """

    def __init__(self, texts: list[bytes], hashes: bool = True):
        joined = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
        space = _SPACE[joined]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        self.text_starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        self.first = np.searchsorted(self.starts, self.text_starts)
        self.bounds = np.append(self.first, len(self.starts))
        self.joined = joined
        if hashes:
            self.hash = run_hashes(_BYTE[joined], self.starts, self.ends)

    def __len__(self) -> int:
        return len(self.starts)

    def doc(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def lowered(texts: list[bytes]) -> list[bytes]:
    return [t.decode("utf-8", "replace").lower().encode() for t in texts]


def stripped(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Byte bounds of the words without ASCII punctuation at either end; words of nothing else stay."""
    inner = _LETTER[words.joined]
    seen = np.concatenate(([0], np.cumsum(inner)))
    at = np.flatnonzero(inner)
    low, high = seen[words.starts], seen[words.ends]
    some = high > low
    start, end = words.starts.copy(), words.ends.copy()
    start[some], end[some] = at[low[some]], at[high[some] - 1] + 1
    return start, end


def stripped_hashes(words: Words) -> np.ndarray:
    return run_hashes(_BYTE[words.joined], *stripped(words))


def pieces(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[slice, list[bytes]]]:
    """Slices of a batch with their texts as bytes, each of about PIECE_BYTES; null is empty."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    taken, begun, size = [], 0, 0
    for at, value in enumerate(texts):
        taken.append(value.as_py() or b"")
        size += len(taken[-1]) + 1
        if size >= PIECE_BYTES:
            yield slice(begun, at + 1), taken
            taken, begun, size = [], at + 1, 0
    if taken:
        yield slice(begun, begun + len(taken)), taken
