"""Severity of toxic language by cumulative-link ordinal regression.

P(grade <= j | x) = sigmoid(threshold_j - w.x): one weight per feature for all
grades, and ordered thresholds. The expected severity is the sum over j of
P(grade > j). The model is fitted on a bounded sample of labelled documents
and applied to every whole document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import _BYTE, Words, lowered, mixed, pieces, run_hashes, stripped

FEATURES = 1 << 18  # classes of features by hash
SAMPLE = 8_000  # labelled documents the model is fitted on, at most about this many
GRADES = 4  # 0: not toxic; 1 to 3: toxic, by thirds of the share of telling words
PREFIXES = (4, 5, 6)  # bytes at the start of a word that form features of their own
LEAST_DOCS = 8  # documents of the sample a feature must occur in
CLEAR = 16.0  # log likelihood ratio (G squared) its occurrence in toxic and other documents must reach
RIDGE, STEPS = 1e-3, 300
REJECT = 0.4  # probability of a grade above 0 from which a document counts as toxic
BLOCK = 1 << 18  # features of the sample the driver works on at once


def features(texts: list[bytes], n_features: int = FEATURES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the distinct features and how often they occur: values, counts, bounds.

    Features are the words in lower case, stripped of what is no letter at
    either end, and the first bytes of each word.
    """
    words = Words(lowered(texts), hashes=False)
    start, end = stripped(words)
    byte = _BYTE[words.joined]
    whole = run_hashes(byte, start, end)
    begins = [mixed(run_hashes(byte, start, np.minimum(start + k, end)) + np.uint64(k)) for k in PREFIXES]
    kind = (np.concatenate([whole, *begins]) % np.uint64(n_features)).astype(np.int64)
    once, counts = np.unique(np.tile(words.doc(), 1 + len(begins)) * n_features + kind, return_counts=True)
    return once % n_features, counts, np.searchsorted(once, np.arange(len(texts) + 1) * n_features)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def exceeding(self, value: np.ndarray, count: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """P(grade > j) for each text (row) and j."""
        sums = np.concatenate(([0.0], np.cumsum(self.weights[value] * np.log1p(count))))
        score = sums[bounds[1:]] - sums[bounds[:-1]]
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def _told_apart(bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> np.ndarray:
    """G squared of the table of documents by kind and by whether they have the feature."""
    total, both = n_bad + n_good, bad + good
    g = np.zeros(len(bad))
    for seen, kind, having in ((bad, n_bad, both), (good, n_good, both), (n_bad - bad, n_bad, total - both), (n_good - good, n_good, total - both)):
        some = seen > 0
        g[some] += 2 * seen[some] * np.log(seen[some] * total / (having[some] * float(kind)))
    return g


def _blocks(bounds: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Documents, and the places of their features, of about BLOCK features each time."""
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + BLOCK, side="right")) - 1)
        yield slice(first, last), slice(int(bounds[first]), int(bounds[last]))
        first = last


def _documents_with(value: np.ndarray, bounds: np.ndarray, toxic: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """For each feature the toxic documents that have it, and the others."""
    bad, good = np.zeros(n_features, np.int64), np.zeros(n_features, np.int64)
    for docs, places in _blocks(bounds):
        side = np.repeat(toxic[docs], np.diff(bounds[docs.start : docs.stop + 1]))
        bad += np.bincount(value[places][side], minlength=n_features)
        good += np.bincount(value[places][~side], minlength=n_features)
    return bad, good


def fitted(value: np.ndarray, count: np.ndarray, bounds: np.ndarray, grade: np.ndarray, n_features: int = FEATURES) -> Model:
    """Maximum likelihood with a ridge on the weights, by Adam; thresholds stay ordered by construction."""
    bad, good = _documents_with(value, bounds, grade > 0, n_features)
    n_bad, n_good = max(1, (grade > 0).sum()), max(1, (grade == 0).sum())
    clear = _told_apart(bad, good, n_bad, n_good) >= CLEAR
    tells = clear & (bad + good >= LEAST_DOCS)
    kept = []
    for docs, places in _blocks(bounds):
        held = np.flatnonzero(tells[value[places]])
        doc = np.repeat(np.arange(docs.start, docs.stop), np.diff(bounds[docs.start : docs.stop + 1]))
        kept.append((value[places][held], doc[held], np.log1p(count[places][held].astype(np.int64))))
    value, doc, x = (np.concatenate(parts) for parts in zip(*kept)) if kept else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    used, column = np.unique(value, return_inverse=True)
    top = int(grade.max()) if len(grade) else 0
    n, k = len(grade), GRADES - 1
    w, first, gaps = np.zeros(len(used)), np.array([1.0]), np.zeros(k - 1)
    if top == 0:
        return Model(np.zeros(n_features), np.arange(k) + 10.0)
    # Toxic and other documents weigh alike together, whatever their numbers.
    share = np.where(grade > 0, 0.5 / max(1, (grade > 0).sum()), 0.5 / max(1, (grade == 0).sum()))
    state = [np.zeros_like(p) for p in (w, first, gaps, w, first, gaps)]
    for step in range(1, STEPS + 1):
        theta = np.concatenate([first, first + np.cumsum(np.exp(gaps))])
        score = np.bincount(doc, w[column] * x, minlength=n)
        edge = np.concatenate([np.full((n, 1), -50.0), np.clip(theta - score[:, None], -50, 50), np.full((n, 1), 50.0)], axis=1)
        cdf = 1 / (1 + np.exp(-edge))
        cdf[:, 0], cdf[:, -1] = 0.0, 1.0
        slope = cdf * (1 - cdf)
        row = np.arange(n)
        p = np.maximum(cdf[row, grade + 1] - cdf[row, grade], 1e-12)
        up, down = slope[row, grade + 1] / p * share, slope[row, grade] / p * share
        by_theta = np.zeros((n, k + 2))
        by_theta[row, grade + 1] -= up
        by_theta[row, grade] += down
        g_theta = by_theta[:, 1:-1].sum(axis=0)
        g_w = np.bincount(column, (up - down)[doc] * x, minlength=len(used)) + RIDGE * w
        g_first = np.array([g_theta.sum()])
        g_gaps = np.cumsum(g_theta[::-1])[::-1][1:] * np.exp(gaps)
        for i, (param, grad) in enumerate(((w, g_w), (first, g_first), (gaps, g_gaps))):
            state[i] = 0.9 * state[i] + 0.1 * grad
            state[i + 3] = 0.999 * state[i + 3] + 0.001 * grad**2
            param -= 0.05 * (state[i] / (1 - 0.9**step)) / (np.sqrt(state[i + 3] / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(n_features)
    weights[used] = w
    return Model(weights, np.concatenate([first, first + np.cumsum(np.exp(gaps))]))


def grades(value: np.ndarray, count: np.ndarray, bounds: np.ndarray, toxic: np.ndarray, n_features: int = FEATURES) -> np.ndarray:
    """Grades from 0/1 labels: 0 where not toxic, else 1 to 3 by the share of telling features.

    A feature tells when its smoothed share among toxic documents is at least
    eight times that among the others. Toxic documents are cut into thirds.
    """
    bad, good = _documents_with(value, bounds, toxic == 1, n_features)
    n_bad, n_good = max(1, toxic.sum()), max(1, (toxic == 0).sum())
    tells = ((bad + 0.5) / n_bad > 8 * (good + 0.5) / n_good) & (bad >= LEAST_DOCS)
    share = np.zeros(len(toxic))
    for docs, places in _blocks(bounds):
        lengths = np.diff(bounds[docs.start : docs.stop + 1])
        doc, n = np.repeat(np.arange(len(lengths)), lengths), count[places].astype(np.int64)
        share[docs] = np.bincount(doc, n * tells[value[places]], minlength=len(lengths)) / np.maximum(1, np.bincount(doc, n, minlength=len(lengths)))
    out = np.zeros(len(toxic), np.int64)
    rank = np.argsort(np.argsort(share[toxic == 1], kind="stable"), kind="stable")
    out[toxic == 1] = 1 + np.minimum(GRADES - 2, rank * (GRADES - 1) // max(1, len(rank)))
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on labelled documents: all of them, or about `sample` chosen by a hash of doc_id where there are more.

    Labels without text or without a value are left out; of repeated labels
    of a document the larger holds, and of equal texts one is taken. Without any toxic label nothing is rejected.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, sample / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 20)) < int(share * (1 << 20)))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                value, count, bounds = features(texts)
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v.astype(np.int32))) for v in (value, count)]
                plain = [batch.column(k).slice(part.start, len(texts)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*plain, *lists], ["doc_id", "toxic", "value", "count"])

    # The chosen labels are few, by `sample`, so they may be broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["text"])
    rows = rows.select("doc_id", F.col("toxic").cast("int"), "text")
    table = rows.mapInArrow(extracted, "doc_id bigint, toxic int, value array<int>, count array<int>").orderBy("doc_id").toArrow()
    toxic = np.asarray(table["toxic"], dtype=np.int64)
    lists = table["value"].combine_chunks()
    bounds = np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths())))).astype(np.int64)
    value, count = (np.asarray(column.flatten()) for column in (lists, table["count"].combine_chunks()))
    # The driver keeps the features as they came, 32-bit numbers, once.
    del table, lists
    return fitted(value, count, bounds, grades(value, count, bounds, toxic))


def severities(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of docs and `severity` (expected grade), `grade` (most probable) and `toxic` (P(grade > 0) >= REJECT).

    A null or empty text has the severity of no features at all. Every row is
    scored on its whole text, repeated rows alike; an empty table gives an empty
    result. Columns of docs named like a result column are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = [c for c in docs.columns if c not in ("severity", "grade", "toxic")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part, texts in pieces(batch):
                over = shared.value.exceeding(*features(texts))
                mass = -np.diff(np.concatenate([np.ones((len(texts), 1)), over, np.zeros((len(texts), 1))], axis=1), axis=1)
                rows = batch.slice(at, len(texts))
                at += len(texts)
                found = [pa.array(over.sum(axis=1)), pa.array(mass.argmax(axis=1), pa.int32()), pa.array(over[:, 0] >= REJECT)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *found], [*plain, "severity", "grade", "toxic"])

    kinds = docs.select(*plain).schema.add("severity", T.DoubleType()).add("grade", T.IntegerType()).add("toxic", T.BooleanType())
    return docs.select(*plain).mapInArrow(scored, kinds)
