"""Approximate nearest neighbours by inner product: an inverted multi-index.

Each vector is cut into two halves, each quantised by its own centroids; a cell
is a pair of centroids. A query scores the centroids of either half and walks
through the pairs by falling sum of the two scores with a heap (the multi-sequence
algorithm). What lies in the cells it passes is scored exactly.

The first walk ends at NEAR entries and gives each query a score its last
neighbour must reach. The second goes on from there, until what a cell may hold at
best stays below that score. What a cell may hold is the score of its
centroids and a margin in units of the spread of its halves. The margin is
fitted: the neighbours of a bounded number of queries are found by brute force
over all rows, and the margin that reaches COVERED of them is taken.

Rows of one first centroid form a shard, large shards are cut into pieces of
bounded size, and a query is sent to the pieces its walk reaches.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stored

SAMPLE = 32_768  # vectors the centroids are fitted on
CENTROIDS = 512  # of a half, at most; a table of all cells is on the driver and in each task
CELL = 12  # entries of a cell aimed at while there are fewer centroids
PIECE = 4_096  # entries of a shard held by a task at once
NEAR = 2_000  # entries of the first walk
ASKED = 64  # queries the margin is fitted on
COVERED = 0.97
ROUNDS = 8

_FOUND = "array<struct<far:double,vec_id:bigint,m1:bigint,m2:bigint>>"


@dataclass(frozen=True)
class Codebook:
    """Centroids of both halves, the spread of their members, entries of each cell, pieces of each shard."""

    centroids: tuple[np.ndarray, np.ndarray]
    spread: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    pieces: np.ndarray
    margin: float = 0.0

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.centroids[0].shape[1]
        return vectors[:, :cut], vectors[:, cut:]

    def scores(self, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What members of each centroid may contribute, for either half."""
        parts = self.halves(vector[None, :])
        return tuple(c @ h[0] + self.margin * np.linalg.norm(h[0]) * s for c, h, s in zip(self.centroids, parts, self.spread))

    def walk(self, vector: np.ndarray, least: int, threshold: float | None) -> list[tuple[int, int]]:
        """Cells with entries: the first that hold `least` entries, or with a threshold those after them that may reach it."""
        found, held = [], 0
        for i, j, best in pairs_by_sum(*self.scores(vector)):
            within, n = held < least, int(self.counts[i, j])
            if not within and (threshold is None or best < threshold):
                break
            held += n
            if n and within == (threshold is None):
                found.append((i, j))
        return found


def pairs_by_sum(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """All pairs of two lists by falling sum; the heap holds at most one pair for each of the first list."""
    by_first, by_second = (np.argsort(-x, kind="stable") for x in (first, second))
    a, b = first[by_first].tolist(), second[by_second].tolist()
    by_first, by_second = by_first.tolist(), by_second.tolist()
    heap = [(-(a[0] + b[0]), 0, 0)] if a and b else []
    while heap:
        total, i, j = heapq.heappop(heap)
        yield by_first[i], by_second[j], -total
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def nearest_centroid(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), dtype=np.int64)
    norms = (centroids * centroids).sum(axis=1)
    for at in range(0, len(points), 4096):
        out[at : at + 4096] = (norms - 2 * points[at : at + 4096] @ centroids.T).argmin(axis=1)
    return out


def centroids_of(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's rounds from k rows drawn at random, so that dense places get many centroids."""
    drawn = np.random.default_rng(1).choice(len(points), min(k, len(points)), replace=False)
    found = points[drawn].copy()
    for _ in range(rounds):
        owner = nearest_centroid(points, found)
        n = np.bincount(owner, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, owner, points)
        found[n > 0] = sums[n > 0] / n[n > 0, None]
    return found


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a column of lists of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def finite_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, vector of the rows that take part.

    Left out are null ids, and vectors that are null, empty, zero, or hold null or non-finite components.
    """
    real = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select("vec_id", real.alias("vector")).where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def filled(rows: DataFrame, size: int) -> DataFrame:
    """vec_id, vector, n1, n2: vectors with zeros up to `size` components, and two hashes of them."""
    filled = F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(size) - F.size("vector")))
    return rows.select("vec_id", filled.alias("vector")).withColumns({"n1": F.xxhash64("vector"), "n2": F.xxhash64(F.lit(1), "vector")})


def entries_of(rows: DataFrame, k: int) -> DataFrame:
    """n1, n2, vector, ids: every different vector once, with its k smallest ids.

    Equal vectors have equal scores, so of their ids only the k smallest can be
    among the k nearest of any query.
    """
    place = F.row_number().over(Window.partitionBy("n1", "n2").orderBy("vec_id"))
    few = rows.withColumn("_place", place).where(F.col("_place") <= k)
    return few.groupBy("n1", "n2").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _assigned(entries: DataFrame, centroids: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The entries with their cell c1, c2 and the squared distances r1, r2 from its centroids."""
    shared = entries.sparkSession.sparkContext.broadcast(centroids)
    names = ["n1", "n2", "vector", "ids", "c1", "c2", "r1", "r2"]

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, cut = matrix(batch.column(2)), shared.value[0].shape[1]
            cells, far = [], []
            for part, own in zip((vectors[:, :cut], vectors[:, cut:]), shared.value):
                cells.append(nearest_centroid(part, own))
                far.append(((part - own[cells[-1]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c.astype(np.int32)) for c in cells), *map(pa.array, far)], names)

    kinds = "n1 bigint, n2 bigint, vector array<double>, ids array<bigint>, c1 int, c2 int, r1 double, r2 double"
    return entries.select(*names[:4]).mapInArrow(assigned, kinds)


@dataclass(frozen=True)
class Index:
    entries: DataFrame
    book: Codebook


def fitted(entries: DataFrame, k: int) -> Index:
    """The index of all entries; centroids and margin are fitted on SAMPLE vectors and ASKED queries."""
    n = entries.count()
    by_hash = entries.orderBy("n2", "n1")
    sample = matrix(pa.chunked_array(by_hash.limit(SAMPLE).select("vector").toArrow().column(0)).combine_chunks())
    wanted = min(CENTROIDS, max(1, round((n / CELL) ** 0.5)))
    cut = sample.shape[1] // 2
    centroids = (centroids_of(sample[:, :cut], wanted), centroids_of(sample[:, cut:], wanted))
    placed = stored(_assigned(entries, centroids), "multi-index")
    sums = [F.sum(c).alias(c) for c in ("r1", "r2")]
    cells = placed.groupBy("c1", "c2").agg(F.sum(F.size("ids")).alias("ids"), F.count(F.lit(1)).alias("n"), *sums).toPandas()
    counts = np.zeros((len(centroids[0]), len(centroids[1])), dtype=np.int64)
    counts[cells.c1, cells.c2] = cells.ids
    spread = []
    for c, r, own in zip(("c1", "c2"), ("r1", "r2"), centroids):
        total, members = (np.bincount(cells[c], cells[v], minlength=len(own)) for v in (r, "n"))
        spread.append(np.sqrt(total / np.maximum(members, 1) / max(1, own.shape[1])))
    pieces = np.maximum(1, -(-np.bincount(cells.c1, cells.n, minlength=len(centroids[0])).astype(np.int64) // PIECE))
    book = Codebook(centroids, tuple(spread), counts, pieces)
    asked = matrix(pa.chunked_array(by_hash.limit(ASKED).select("vector").toArrow().column(0)).combine_chunks())
    return Index(placed, replace(book, margin=_margin(placed, book, asked, k)))


def nearest_exactly(placed: DataFrame, asked: np.ndarray, k: int) -> DataFrame:
    """query (row of asked), far (the negative score), vec_id, c1, c2 of the k nearest of all entries, by brute force in blocks."""
    shared = placed.sparkSession.sparkContext.broadcast(asked)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = -products(shared.value, matrix(batch.column(0)))
            query, entry = np.nonzero(far <= np.partition(far, min(k, far.shape[1]) - 1, axis=1)[:, [min(k, far.shape[1]) - 1]])
            rest = batch.select(["ids", "c1", "c2"]).take(pa.array(entry))
            yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(far[query, entry]), *rest.columns], ["query", "far", "ids", "c1", "c2"])

    kinds = "query int, far double, ids array<bigint>, c1 int, c2 int"
    near = placed.select("vector", "ids", "c1", "c2").mapInArrow(scored, kinds)
    near = near.select("query", "far", F.explode("ids").alias("vec_id"), "c1", "c2")
    place = F.row_number().over(Window.partitionBy("query").orderBy("far", "vec_id"))
    return near.withColumn("place", place).where(F.col("place") <= k)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of all rows, each summed from the first component to the last."""
    out = np.zeros((len(queries), len(vectors)))
    for q, v in zip(queries.T, vectors.T):
        out += q[:, None] * v[None, :]
    return out


def _margin(placed: DataFrame, book: Codebook, asked: np.ndarray, k: int) -> float:
    """The margin with which COVERED of the true neighbours of `asked` lie in cells that may reach the last of them."""
    needed = []
    for query, rows in nearest_exactly(placed, asked, k).toPandas().groupby("query"):
        parts = book.halves(asked[query][None, :])
        plain = sum((c @ h[0])[rows[i]] for c, h, i in zip(book.centroids, parts, ("c1", "c2")))
        unit = sum(np.linalg.norm(h[0]) * s[rows[i]] for h, s, i in zip(parts, book.spread, ("c1", "c2")))
        needed.append((-rows.far.max() - plain) / np.maximum(unit, 1e-300))
    flat = np.maximum(0, np.concatenate(needed)) if needed else np.zeros(1)
    return float(np.quantile(flat, COVERED, method="higher"))


def _visits(queries: DataFrame, index: Index, again: bool) -> DataFrame:
    """A row for each query and piece it is sent to, with the second centroids of the cells to be read."""
    shared = index.entries.sparkSession.sparkContext.broadcast(index.book)
    names = ["shard", "piece", "kind", "n1", "n2", "vector", "numbers", "c2", "least"]

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        for batch in batches:
            vectors, least = matrix(batch.column(2)), batch.column(3).to_numpy(zero_copy_only=False)
            for at in range(0, len(vectors), 64):
                of, shard, piece, cells = [], [], [], []
                for k in range(at, min(at + 64, len(vectors))):
                    by_shard = defaultdict(list)
                    for i, j in book.walk(vectors[k], NEAR, least[k] if again else None):
                        by_shard[i].append(j)
                    for i, js in by_shard.items():
                        for p in range(book.pieces[i]):
                            of.append(k)
                            shard.append(i)
                            piece.append(p)
                            cells.append(js)
                rows = batch.take(pa.array(of, pa.int64()))
                fixed = [pa.array(shard, pa.int32()), pa.array(piece, pa.int32()), pa.array([1] * len(of), pa.int32()), *rows.columns[:3]]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(cells, pa.list_(pa.int64())), pa.array([0] * len(of), pa.int32()), rows.column(3)], names)

    return queries.select("n1", "n2", "vector", "least").mapInArrow(sent, _PROBE)


_PROBE = "shard int, piece int, kind int, n1 bigint, n2 bigint, vector array<double>, numbers array<bigint>, c2 int, least double"


def _probed(index: Index, visits: DataFrame, k: int) -> DataFrame:
    """n1, n2, found: for each visit the entries that can be among the k nearest, scored exactly.

    A piece is read before its visits; these stream by in blocks, however many there are.
    """
    spark = visits.sparkSession
    many = spark.createDataFrame([(i, int(p)) for i, p in enumerate(index.book.pieces)], "c1 int, pieces int")
    placed = index.entries.join(F.broadcast(many), "c1")
    entries = placed.select(
        F.col("c1").alias("shard"), F.pmod("n2", "pieces").cast("int").alias("piece"), F.lit(0).alias("kind"), "n1", "n2", "vector",
        F.col("ids").alias("numbers"), "c2", F.lit(0.0).alias("least"),
    )
    width = len(index.book.centroids[1])
    both = entries.unionByName(visits).repartition("shard", "piece").sortWithinPartitions("shard", "piece", "kind")

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, piece, held = None, None, []
        for batch in batches:
            shard, part, kind = (batch.column(c).to_numpy() for c in range(3))
            edges = np.flatnonzero((np.diff(shard) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(kind)]):
                if b == a:
                    continue
                rows = batch.slice(a, b - a)
                if key != (shard[a], part[a]):
                    key, piece, held = (shard[a], part[a]), None, []
                if kind[a] == 0:
                    held.append(rows)
                    continue
                if piece is None:
                    piece = Piece(pa.Table.from_batches(held).combine_chunks())
                for at in range(0, len(rows), 256):
                    yield piece.answers(rows.slice(at, 256), width, k)

    return both.mapInArrow(answered, f"n1 bigint, n2 bigint, found {_FOUND}")


class Piece:
    """Entries of one shard, held by a task."""

    def __init__(self, rows: pa.Table):
        numbers = rows.column("numbers").combine_chunks()
        self.vectors = matrix(rows.column("vector").combine_chunks())
        self.c2 = rows.column("c2").to_numpy()
        self.m1, self.m2 = (rows.column(c).to_numpy() for c in ("n1", "n2"))
        self.ids = numbers.flatten().to_numpy()
        self.bounds = np.concatenate(([0], np.cumsum(numbers.value_lengths().to_numpy())))

    def answers(self, visits: pa.RecordBatch, width: int, k: int) -> pa.RecordBatch:
        queries, cells = matrix(visits.column(5)), visits.column(6)
        least = visits.column(8).fill_null(-np.inf).to_numpy()
        asked = np.zeros((len(queries), width), dtype=bool)
        asked[np.repeat(np.arange(len(queries)), cells.value_lengths().to_numpy()), cells.flatten().to_numpy()] = True
        open_ = asked[:, self.c2]
        # Products by blocks leave out what cannot be in; what may be is scored again, component by component.
        rough = np.where(open_, queries @ self.vectors.T, -np.inf)
        few = min(k, rough.shape[1])
        slack = 1e-9 * (1 + np.abs(queries).max(axis=1, initial=0) * np.abs(self.vectors).max(initial=0) * queries.shape[1])
        bound = np.maximum(np.partition(rough, -few, axis=1)[:, -few], least) - slack
        query, entry = np.nonzero(open_ & (rough >= bound[:, None]))
        score = np.zeros(len(query))
        for q, v in zip(queries.T, self.vectors.T):
            score += q[query] * v[entry]
        sizes = self.bounds[entry + 1] - self.bounds[entry]
        each = np.repeat(np.arange(len(entry)), sizes)
        number = self.ids[np.repeat(self.bounds[entry] - np.cumsum(sizes) + sizes, sizes) + np.arange(len(each))]
        order = np.lexsort((number, -score[each], query[each]))
        each, number = each[order], number[order]
        first = np.searchsorted(query[each], np.arange(len(queries)))
        stays = np.arange(len(each)) - first[query[each]] < k
        each, number = each[stays], number[stays]
        offsets = np.searchsorted(query[each], np.arange(len(queries) + 1)).astype(np.int32)
        fields = [pa.array(-score[each]), pa.array(number), pa.array(self.m1[entry[each]]), pa.array(self.m2[entry[each]])]
        found = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["far", "vec_id", "m1", "m2"]))
        return pa.RecordBatch.from_arrays([visits.column(3), visits.column(4), found], ["n1", "n2", "found"])


def _merged(found: DataFrame, k: int) -> DataFrame:
    """n1, n2, found: the k nearest of all lists of a query, nearest first, ties by smaller id."""
    each = F.sort_array(F.flatten(F.collect_list("found")))
    return found.groupBy("n1", "n2").agg(F.slice(each, 1, k).alias("found"))


def search(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """n1, n2, found: for each query vector (n1, n2, vector) the k nearest entries of both walks."""
    first = _probed(index, _visits(queries.withColumn("least", F.lit(None).cast("double")), index, False), k)
    first = stored(_merged(first, k), "first-walk")
    # Whoever has not met k entries yet walks on to the end.
    last = F.coalesce(-F.get("found", F.lit(k - 1))["far"], F.lit(float("-inf")))
    bounded = queries.join(first.select("n1", "n2", last.alias("least")), ["n1", "n2"], "left")
    bounded = bounded.withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    second = _probed(index, _visits(bounded, index, True), k)
    return _merged(first.unionByName(second), k)


def neighbours(vectors: DataFrame, queries: DataFrame | None = None, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query, by inner product in double precision.

    Both tables have vec_id and embedding; `queries` must be rows of `vectors` (default: all).
    A query's own row is no candidate; other rows with its id or its vector
    are. Ties go to the smaller vec_id. Rows that are not among `finite_rows` take no part, as
    queries or candidates; a vector shorter than the longest is filled with zeros. Query rows that repeat id and vector are
    answered once. Empty tables give no rows; further columns are ignored. `vec_id` must be a whole number.
    """
    found = finite_rows(vectors)
    size = found.agg(F.max(F.size("vector"))).first()[0] or 0
    rows = filled(found, size)
    asked = filled(finite_rows(queries), size) if queries is not None else rows
    entries = stored(entries_of(rows, k + 1), "distinct-vectors")
    asked = stored(asked.select("vec_id", "n1", "n2").distinct(), "queries")
    kinds = "query_id bigint, rank int, vec_id bigint, score double"
    if asked.isEmpty() or entries.isEmpty():
        return vectors.sparkSession.createDataFrame([], kinds)
    index = fitted(entries, k + 1)
    texts = index.entries.select("n1", "n2", "vector").join(asked.select("n1", "n2").distinct(), ["n1", "n2"])
    near = stored(search(index, texts, k + 1), "nearest")
    held = asked.withColumnRenamed("vec_id", "query_id").join(near, ["n1", "n2"])
    is_own = F.transform("found", lambda x: (x["vec_id"] == F.col("query_id")) & (x["m1"] == F.col("n1")) & (x["m2"] == F.col("n2")))
    own = F.array_position(is_own, F.lit(True))
    others = F.slice(F.filter("found", lambda x, i: i + 1 != F.col("own")), 1, k)
    each = held.withColumn("own", own).select("query_id", F.posexplode(others).alias("place", "one"))
    return each.select("query_id", (F.col("place") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), (-F.col("one.far")).alias("score"))
