"""Substring dedup: seed on winnowed anchors, extend both ways, keep maximal repeats.

Every window of WINDOW words selects the smallest of the hashes of its runs of
SEED words, so equal windows hold an equal anchor at the same place. Anchors
are joined by hash. An anchor need be extended by at most WINDOW - SEED words
to each side: a longer repeat is the union of windows, each with its anchor.

Occurrences of an anchor with the same full context on both sides repeat as a
whole and are settled by one count, however many copies there are. Only where
occurrences of an anchor differ in their contexts is each distinct context
extended word by word, through the windows that hold the anchor; those are
grouped by their two hashes. Nothing is ever paired with each of its copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import KEY, Scratch, Words, mixed, pieces, run_hashes, text_or_empty

WINDOW = 35
SEED = 8
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, row, version, text: rows known by two 64-bit hashes of doc_id, whether it is null, and text. Rows equal in these are one."""
    text, none = text_or_empty(), F.col("doc_id").isNull()
    return docs.select(
        "doc_id", F.xxhash64("doc_id", none, text).alias("row"), F.xxhash64(text, none, "doc_id", F.lit(1)).alias("version"), text.alias("text")
    )


def _two(words: Words, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return run_hashes(words.hash, starts, ends), run_hashes(mixed(words.hash ^ _SECOND), starts, ends)


def _anchors(words: Words, window: int, seed: int) -> np.ndarray:
    """Places of the anchors: of each window the leftmost smallest seed hash."""
    n, width = len(words), window - seed + 1
    if n < window:
        return np.zeros(0, np.int64)
    place = np.arange(n - seed + 1)
    hashes = run_hashes(words.hash, place, place + seed)
    # The smallest place of the smallest hash in each run of `width` seeds, by doubling.
    low, at, reach = hashes, place, 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = low[: len(low) - step], low[step:]
        takes = right < left
        low, at = np.where(takes, right, left), np.where(takes, at[step:], at[: len(at) - step])
        reach += step
    # Windows that lie in one text only.
    within = words.bounds[1:][words.doc()[: len(at)]] - np.arange(len(at)) >= window
    return np.unique(at[within])


def anchors(rows: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """row, version, pos, anchor, context: the seeds of all texts.

    `pos` counts words from the text's start; `context` is a hash of all words
    that windows with this anchor may reach, and of where the anchor lies in them.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, version = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for part, texts in pieces(batch):
                words = Words(texts)
                at = _anchors(words, window, seed)
                doc = np.searchsorted(words.bounds, at, side="right") - 1
                first, end = words.bounds[doc], words.bounds[doc + 1]
                left = np.maximum(at - (window - seed), first)
                around = run_hashes(words.hash, left, np.minimum(at + window, end))
                context = mixed(around ^ (at - left).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row[part][doc], pa.int64()),
                        pa.array(version[part][doc], pa.int64()),
                        pa.array((at - first).astype(np.int32)),
                        pa.array(run_hashes(words.hash, at, at + seed).view(np.int64)),
                        pa.array(context.view(np.int64)),
                    ],
                    ["row", "version", "pos", "anchor", "context"],
                )

    kinds = "row bigint, version bigint, pos int, anchor bigint, context bigint"
    return rows.select(*KEY, "text").mapInArrow(found, kinds)


def _windows(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """row, version, start, w1, w2 of every window that holds an anchor listed in `places`."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, version = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            places = batch.column(3)
            for part, texts in pieces(batch):
                words = Words(texts)
                doc, starts = [], []
                for k in range(len(texts)):
                    first, end = words.bounds[k], words.bounds[k + 1]
                    at = np.asarray(places[part.start + k].as_py(), dtype=np.int64) + first
                    reach = (at[:, None] - np.arange(window - seed + 1)).ravel()
                    starts.append(np.unique(reach[(reach >= first) & (reach + window <= end)]))
                    doc.append(np.full(len(starts[-1]), k))
                start, of = np.concatenate(starts), np.concatenate(doc)
                other = run_hashes(mixed(words.hash ^ _SECOND), start, start + window)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row[part][of], pa.int64()),
                        pa.array(version[part][of], pa.int64()),
                        pa.array((start - words.bounds[of]).astype(np.int32)),
                        pa.array(run_hashes(words.hash, start, start + window).view(np.int64)),
                        pa.array((other >> np.uint64(33)).astype(np.int32)),
                    ],
                    ["row", "version", "start", "w1", "w2"],
                )

    kinds = "row bigint, version bigint, start int, w1 bigint, w2 int"
    return rows.select(*KEY, "text", "places").mapInArrow(listed, kinds)


def with_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc_id, text, spans: word ranges (start, end) whose union is that of the maximal repeats.

    A range may reach beyond the text's end, where the text ends then; spans is
    null where nothing repeats. Repeated rows repeat each other as a whole.
    """
    rows, scratch = identified(docs), Scratch(docs.sparkSession)
    seeds = anchors(rows, window, seed)
    # Each step is written, so that joins on a hot anchor or context can be split, and deleted when it has been read.
    met = scratch.put(seeds.groupBy("anchor").count().where("count > 1").select("anchor"), "repeated-anchors")
    occurrences = scratch.put(seeds.join(met, "anchor"), "occurrences")
    scratch.drop("repeated-anchors")
    one = F.xxhash64(*KEY, "pos")
    every = scratch.put(
        occurrences.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("first")), "contexts"
    )
    several = every.groupBy("anchor").count().where("count > 1").select("anchor", F.lit(True).alias("differs"))
    contexts = scratch.put(every.join(several, "anchor", "left").where("n > 1 or differs"), "telling-contexts")
    scratch.drop("contexts")
    # One occurrence of each context speaks for all of them.
    judged = occurrences.join(contexts, ["anchor", "context"]).select(
        *KEY, "pos", (F.col("n") > 1).alias("whole"), (F.col("differs").isNotNull() & (one == F.col("first"))).alias("extend")
    )
    judged = scratch.put(judged.where("whole or extend"), "judged-anchors")
    scratch.drop("occurrences", "telling-contexts")
    places = judged.where("extend").groupBy(*KEY).agg(F.collect_set("pos").alias("places"))
    windows = _windows(rows.drop("doc_id").join(places.hint("shuffle_hash"), KEY), window, seed)
    # A text lists a window once, so two rows are two places (or rows that repeat as a whole).
    again = windows.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    extended = windows.join(again, ["w1", "w2"]).select(
        *KEY, F.struct(F.col("start"), (F.col("start") + window).alias("end")).alias("span")
    )
    reach = F.struct(
        F.greatest(F.lit(0), F.col("pos") - (window - seed)).alias("start"), (F.col("pos") + window).alias("end")
    )
    whole = judged.where("whole").select(*KEY, reach.alias("span"))
    # Written before the texts move, so that the shuffled windows are gone by then.
    spans = scratch.put(whole.union(extended).groupBy(*KEY).agg(F.collect_set("span").alias("spans")), "spans")
    scratch.drop("judged-anchors")
    return rows.join(spans.hint("shuffle_hash"), KEY, "left").select("doc_id", "text", "spans")


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept (the words left, joined by a space).

    Words are runs of anything but the six ASCII white-space characters. Every
    word that lies in a run of `window` words which also starts elsewhere, in
    the same text or another, is removed; all runs are judged on the input. A
    null, empty or short text repeats nothing; rows that repeat as a whole
    lose everything from `window` words on. Further columns are ignored.
    """

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2)
            n_words, n_removed, left = [], [], []
            for k, text in enumerate(batch.column(1)):
                words = text.as_py().encode().split()
                found = spans[k].values
                gone = np.zeros(len(words) + 1, dtype=np.int32)
                if found is not None and len(found):
                    starts = found.field("start").to_numpy()
                    ends = np.minimum(found.field("end").to_numpy(), len(words))
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, ends, -1)
                stays = np.cumsum(gone)[:-1] == 0
                n_words.append(len(words))
                n_removed.append(int(len(words) - stays.sum()))
                left.append(b" ".join(words if stays.all() else [words[i] for i in np.flatnonzero(stays)]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(left, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    kinds = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    return with_spans(docs, window, seed).mapInArrow(kept, kinds)
