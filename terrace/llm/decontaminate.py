"""Benchmark decontamination: BM25 inverted index of the test items, searched by block-max WAND.

Every passage of every document is a query. Scores are BM25 with each item's
weights divided by their sum, so a passage that holds all of an item's words
scores 1 and one threshold suits all items. Bounds per block of items, summed
for all passages of a batch at once, rule out nearly every block; what is left
is searched document at a time with cursors, pivots and block bounds, and all
items above the threshold are retrieved. A retrieved item counts when the
document holds its shingles, and the words of its question and of its answer.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import Words, lowered, pieces, run_hashes, stored, stripped_hashes, text_or_empty

CELL = 64  # words; a passage is two cells and starts every cell, so an entry of a cell's length lies within one
THRESHOLD = 0.7  # of an item's own score, to be retrieved
SHINGLE, SIMILAR = 5, 0.8
K1, B = 1.2, 0.75
BLOCK = 8  # entries
SHARD_CHARS = 2_000_000  # of item text in one index, the size of what is broadcast
SUMS = 500_000  # of bounds held at once


class Index:
    """Entries of up to CELL words of the items, with weights by BM25 and bounds by block."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        self.owner: list[int] = []
        entries: list[np.ndarray] = []
        for number, text in items:
            question, answer = parts(text)
            w = stripped_hashes(Words(lowered([f"{question}\n{answer}".encode()])))
            if not len(w):
                continue
            n_answer = len(Words([answer.encode()], hashes=False))
            self.items.append((number, shingles(w), np.unique(w[: len(w) - n_answer]), np.unique(w[len(w) - n_answer :])))
            for at in range(0, len(w), CELL):
                entries.append(w[at : at + CELL])
                self.owner.append(len(self.items) - 1)
        every = np.concatenate(entries) if entries else np.zeros(0, np.uint64)
        self.terms = np.unique(every)
        n = len(entries)
        lengths = np.array([len(e) for e in entries], float)
        entry = np.repeat(np.arange(n), lengths.astype(int))
        pair, tf = np.unique(np.searchsorted(self.terms, every) * max(1, n) + entry, return_counts=True)
        term, entry = pair // max(1, n), pair % max(1, n)
        df = np.bincount(term, minlength=len(self.terms))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[entry] / max(1.0, lengths.mean() if n else 1.0)))
        weight = weight / np.bincount(entry, weight, minlength=n)[entry]
        self.first = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.entry, self.weight = entry, weight
        # Bounds of the blocks a term occurs in, term after term.
        self.blocks = -(-n // BLOCK)
        at = np.flatnonzero(np.diff(term * max(1, self.blocks) + entry // BLOCK, prepend=-1))
        self.block = (entry // BLOCK)[at]
        self.bound = np.maximum.reduceat(weight, at) if len(at) else weight
        self.block_first = np.searchsorted(term[at], np.arange(len(self.terms) + 1))
        self.most = np.maximum.reduceat(weight, self.first[:-1]) if len(weight) else weight

    def block_bounds(self, term: int) -> dict[int, float]:
        held = slice(self.block_first[term], self.block_first[term + 1])
        return dict(zip(self.block[held].tolist(), self.bound[held].tolist()))

    def best_blocks(self, terms: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
        """For each of n passages the highest sum of bounds over blocks; `passage` numbers the terms' passages."""
        sizes = self.block_first[terms + 1] - self.block_first[terms]
        rows = np.repeat(self.block_first[terms] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        sums = np.bincount(np.repeat(passage, sizes) * self.blocks + self.block[rows], self.bound[rows], minlength=n * self.blocks)
        return sums.reshape(n, self.blocks).max(axis=1)

    def retrieve(self, query: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: all (entry, score) of at least the threshold for distinct query terms."""
        lists = [(self.entry[a:b].tolist(), self.weight[a:b].tolist(), float(self.most[t]), self.block_bounds(t)) for t in query for a, b in [self.first[t : t + 2]]]
        at = [0] * len(lists)
        found, end = [], 1 << 60
        head = [x[0][0] for x in lists]
        while True:
            order = sorted(range(len(lists)), key=head.__getitem__)
            bound, pivot = 0.0, end
            for i in order:
                if head[i] == end:
                    break
                bound += lists[i][2]
                if bound >= threshold:
                    pivot = head[i]
                    break
            if pivot == end:
                return found
            ahead = [i for i in order if head[i] <= pivot]
            block = pivot // BLOCK
            if sum(lists[i][3].get(block, 0.0) for i in ahead) < threshold:
                # No entry from here to the end of the block, or to the next list's head, can do it.
                later = min((head[i] for i in order if head[i] > pivot), default=end)
                target = min((block + 1) * BLOCK, later)
            elif head[order[0]] == pivot:
                score = sum(lists[i][1][at[i]] for i in ahead)
                if score >= threshold:
                    found.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            for i in ahead:
                if head[i] < target:
                    at[i] = bisect_left(lists[i][0], target, at[i])
                    head[i] = lists[i][0][at[i]] if at[i] < len(lists[i][0]) else end


def parts(text: str) -> tuple[str, str]:
    """Question and answer of an item: all sentences but the last, and the last; of one sentence the last third of its words."""
    text = text.strip()
    ends = [m.end() for m in re.finditer(r"[.?!](?=\s)|\n", text)]
    if ends and text[ends[-1] :].split():
        return text[: ends[-1]], text[ends[-1] :]
    words = text.split()
    cut = len(words) - len(words) // 3
    return " ".join(words[:cut]), " ".join(words[cut:])


def shingles(w: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    start = np.arange(max(1, len(w) - size + 1)) if len(w) else np.zeros(0, np.int64)
    return np.unique(run_hashes(w, start, np.minimum(start + size, len(w))))


def _held(index: Index, item: int, words: np.ndarray, document: np.ndarray, sizes: dict) -> bool:
    _, wanted, question, answer = index.items[item]
    n = len(question) + len(answer)
    there = document if len(wanted) > 1 or n >= SHINGLE else sizes.setdefault(n, shingles(words, n))
    if np.isin(wanted, there, assume_unique=True).mean() < SIMILAR:
        return False
    return all(not len(p) or np.isin(p, words).mean() >= SIMILAR for p in (question, answer))


def _search(index: Index, texts: list[bytes], threshold: float) -> list[dict[int, float]]:
    """For each text the numbers of the index's items it holds, with the best score."""
    words = Words(lowered(texts))
    hashes = stripped_hashes(words)
    out: list[dict[int, float]] = [{} for _ in texts]
    if not len(hashes) or not len(index.terms):
        return out
    term = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    met = np.flatnonzero(index.terms[term] == hashes)
    doc = words.doc()
    # Cells are numbered through all texts, with a spare one between texts.
    cells = np.diff(words.bounds) // CELL + 2
    base = np.cumsum(cells) - cells + 1
    cell = base[doc[met]] + (met - words.bounds[:-1][doc[met]]) // CELL
    n = len(index.terms)
    once = np.unique(np.concatenate([cell * n + term[met], (cell - 1) * n + term[met]]))
    passage, terms = once // n, once % n
    begin = np.flatnonzero(np.diff(passage, prepend=-1))
    reach = np.add.reduceat(index.most[terms], begin)
    ends = np.append(begin[1:], len(terms))
    possible = np.flatnonzero(reach >= threshold)
    for some in np.array_split(possible, len(possible) * index.blocks // SUMS + 1):
        if not len(some):
            continue
        sizes = ends[some] - begin[some]
        rows = np.repeat(begin[some] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        bound = index.best_blocks(terms[rows], np.repeat(np.arange(len(some)), sizes), len(some))
        for k in some[bound >= threshold - 1e-4]:
            of = int(np.searchsorted(base - 1, passage[begin[k]], side="right") - 1)
            for entry, score in index.retrieve(terms[begin[k] : ends[k]], threshold):
                item = index.owner[entry]
                out[of][item] = max(score, out[of].get(item, 0.0))
    for of, found in enumerate(out):
        if found:
            own = hashes[words.bounds[of] : words.bounds[of + 1]]
            document, other = shingles(own), {}
            out[of] = {i: s for i, s in found.items() if _held(index, i, own, document, other)}
    return out


def indexes(items: DataFrame, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """shard, index: a pickled Index for each shard of the different items, built in tasks and written.

    The number of shards follows the text there is. An empty table has none.
    """
    items = items.select("item_id", text_or_empty().alias("text")).where("text != ''").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = -(-total // shard_chars)
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, shards))))

    def built(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        index = Index(sorted(zip(held["item_id"].tolist(), held["text"])))
        return pd.DataFrame({"shard": [key[0]], "index": [pickle.dumps(index)]})

    return stored(dealt.groupBy("shard").applyInPandas(built, "shard bigint, index binary"), "item-indexes")


def _searched(docs: DataFrame, index: bytes, threshold: float, every: bool) -> tuple[DataFrame, Broadcast]:
    """docs with items and score by one index, all rows or only those that hold some; and the broadcast to be given up later."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    names = [*docs.columns, "items", "score"]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(shared.value)
        for batch in batches:
            for part, texts in pieces(batch):
                found = _search(own, texts, threshold)
                ids = pa.array([sorted({own.items[i][0] for i in f}) for f in found], pa.list_(pa.int64()))
                best = pa.array([max(f.values(), default=0.0) for f in found], pa.float64())
                rows = batch.slice(part.start, len(texts))
                out = pa.RecordBatch.from_arrays([*rows.columns, ids, best], names)
                yield out if every else out.filter(pa.array([bool(f) for f in found], pa.bool_()))

    kinds = T.StructType([*docs.schema.fields, T.StructField("items", T.ArrayType(T.LongType())), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(searched, kinds), shared


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The columns of docs, then `items` (ids of the test items a document holds, ascending) and `score` (the best, else 0).

    Words are compared in lower case without punctuation at their ends. An item
    is held when at least SIMILAR of its distinct shingles of five words occur
    in the document, and SIMILAR of the words of its question and of its answer.
    Null and empty texts hold nothing; items without words or without an id are
    never held; repeated items and rows are treated alike, texts of any length are
    searched whole. Empty tables give no items. Columns of docs named like a
    result column are replaced.

    Of a benchmark of several shards one index at a time is held by the driver and
    the executors: each is searched in a pass of its own that writes what it found,
    by the texts' hashes, and what all found is joined to the rows.
    """
    # Columns of any name travel in one, beside the text.
    plain = [c for c in docs.columns if c not in ("items", "score")]
    others = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in plain if c != "text"]).alias("_others")
    rows = docs.select(others, "text")
    result = [(F.col("text") if c == "text" else F.col("_others").getField(c)).alias(c) for c in plain]
    built = indexes(items.where("item_id IS NOT NULL"), shard_chars)
    shards = [r.shard for r in built.select("shard").collect()]

    def index_of(shard: int) -> bytes:
        return bytes(built.where(F.col("shard") == shard).first()["index"])

    if not shards:
        nothing = [F.array().cast("array<bigint>").alias("items"), F.lit(0.0).alias("score")]
        return rows.select(*result, *nothing)
    if len(shards) == 1:
        return _searched(rows, index_of(shards[0]), threshold, every=True)[0].select(*result, "items", "score")
    found = None
    texts = docs.select(F.md5(text_or_empty().cast("binary")).alias("version"), "text")
    for shard in shards:
        some, shared = _searched(texts, index_of(shard), threshold, every=False)
        some = stored(some.select("version", "items", "score").distinct(), "held-items")
        shared.destroy()
        found = some if found is None else found.union(some)
    found = found.groupBy("version").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("score").alias("score"))
    whole = rows.withColumn("version", F.md5(text_or_empty().cast("binary"))).join(found, "version", "left")
    none = F.array().cast("array<bigint>")
    return whole.select(*result, F.coalesce("items", none).alias("items"), F.coalesce("score", F.lit(0.0)).alias("score"))
