"""Prefix trie of conversations, counted through flat arrays behind minimal perfect hashes.

A node is a distinct sequence of first turns and is known by a 128-bit digest
chained from turn to turn. Digests are enumerated by grouping; each node belongs to the
smallest conversation that starts with it, its owner. Sums over subtrees need no subtree
in one place: owners' paths are dealt over shards along their first turns, and the
weight of a node is put on its owner's path only, so the sums of all shards add up.

Within a shard the distinct digests get slots of a minimal perfect hash; a slot
is verified against the digest it holds. Weights are scattered into flat arrays by
slot, and added from each depth to the one above through an array of parent slots.

A long path is cut into segments of SEGMENT turns, which are accumulated apart;
what an owner holds in later segments is put on the last node of each segment before.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import mixed, stored

SEGMENT = 256  # turns of a path that are accumulated together
BLOCK = 200_000  # path rows of a shard that a task holds at once
ROOT = (0, 0)

_NODE = ["k1", "k2"]


def turn_key(role: Column, text: Column) -> Column:
    """128 bits of a hash of a turn; the role's length keeps role and text apart."""
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(told, 256), 1, 32))


def conversation_rows(table: DataFrame) -> DataFrame:
    """conv_id, part, place, key, bytes: each conversation's turns from place 1 on, and a row without a key at place 0.

    Turns are ordered by `turn`, null first; equal turns by their key. Null roles and
    texts are empty; rows without a conv_id are left out. Texts themselves are not moved.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = table.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", turn_key(role, text).alias("key"), F.octet_length(text).cast("bigint").alias("bytes")
    )
    along = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "key")
    placed = rows.select("conv_id", F.lit(1).alias("part"), F.row_number().over(along).alias("place"), "key", "bytes")
    none = F.lit(None).cast("binary")
    starts = rows.select("conv_id").distinct().select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("place"), none.alias("key"), F.lit(0).cast("bigint").alias("bytes"))
    return placed.unionByName(starts)


def with_shared_heads(rows: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations rebuilt from `conversation_rows`: the first h turns are those of conversation c - c % every.

    h is the CRC-32 of the decimal conv_id modulo `most`; if that conversation has
    fewer turns all are taken, and none if it is absent. Then come c's own turns after its
    first h. For negative c the remainder is not negative.
    """
    own = F.crc32(F.col("conv_id").cast("string")) % most
    remainder = F.pmod("conv_id", F.lit(every))
    starts = rows.where("part = 0")
    heads = rows.where((F.col("part") == 1) & (F.col("place") < most) & (remainder == 0))
    heads = heads.select(F.col("conv_id").alias("base"), F.lit(1).alias("part"), "place", "key", "bytes")
    wanted = starts.select("conv_id", (F.col("conv_id") - remainder).alias("base"), own.alias("h"))
    taken = wanted.join(heads, "base").where("place <= h").select("conv_id", "part", "place", "key", "bytes")
    rest = rows.where((F.col("part") == 1) & (F.col("place") > own)).withColumn("part", F.lit(2))
    return starts.unionByName(taken).unionByName(rest)


def paths(rows: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2, p1, p2, bytes, top, last: a row for each prefix of each conversation.

    Conversations stream by in order, so one of any length needs no memory; one
    task reads it. `top` is the digest of the first turn, `last` marks the end.
    """
    kinds = "conv_id bigint, depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, bytes bigint, top bigint, last boolean"
    names = [k.split()[0] for k in kinds.split(", ")]
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 8 + [pa.bool_()]
        before: tuple | None = None  # waits to be told whether it is its conversation's last
        digest, top = b"", 0

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

        for batch in batches:
            found = []
            for conv, key, size in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if key is None:
                    digest, top, now = bytes(16), 0, (conv, 0, *ROOT, None, None, 0, 0)
                else:
                    digest = hashlib.blake2b(digest + key, digest_size=16).digest()
                    k1, k2 = struct.unpack("<qq", digest)
                    if before[1] == 0:
                        top, before = k1, (*before[:7], k1)
                    now = (conv, before[1] + 1, k1, k2, before[2], before[3], size, top)
                if before is not None:
                    found.append((*before, before[0] != conv))
                before = now
            if found:
                yield batch_of(found)
        if before is not None:
            yield batch_of([(*before, True)])

    return ordered.select("conv_id", "key", "bytes").mapInArrow(chained, kinds)


class PerfectHash:
    """Slots 0 to n - 1 for n different 128-bit keys, without gaps.

    In each level keys fall on places of a bitmap; those alone on a place keep
    it, the others go on to the next level. A slot is the rank of the place. The
    table of keys by slot verifies every answer.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.first, self.second = np.empty_like(first), np.empty_like(second)
        left, offset = np.arange(len(first)), 0
        while len(left):
            place, size = self._places(first[left], second[left], len(self.levels), 2 * len(left) + 1)
            alone = np.bincount(place, minlength=size) == 1
            ranks = np.cumsum(alone) - 1 + offset
            self.levels.append((alone, ranks))
            kept = alone[place]
            slots = ranks[place[kept]]
            self.first[slots], self.second[slots] = first[left[kept]], second[left[kept]]
            left, offset = left[~kept], offset + int(alone.sum())

    @staticmethod
    def _places(first: np.ndarray, second: np.ndarray, level: int, size: int) -> tuple[np.ndarray, int]:
        seed = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        spread = mixed(mixed(first.view(np.uint64) ^ seed) + second.view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        return (spread % np.uint64(size)).astype(np.int64), size

    def __len__(self) -> int:
        return len(self.first)

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not in the table."""
        found, open_ = np.full(len(first), -1), np.arange(len(first))
        for level, (alone, ranks) in enumerate(self.levels):
            place, _ = self._places(first[open_], second[open_], level, len(alone))
            hit = alone[place]
            found[open_[hit]] = ranks[place[hit]]
            open_ = open_[~hit]
        known = found >= 0
        known[known] = (self.first[found[known]] == first[known]) & (self.second[found[known]] == second[known])
        return np.where(known, found, -1)


def subtree_sums(columns: dict[str, np.ndarray], segment: int = SEGMENT) -> tuple[PerfectHash, np.ndarray, np.ndarray]:
    """The table of a shard's nodes, and for each slot the leaves and saved tokens on the paths below it.

    Parents are followed within a segment only.
    """
    first, second = columns["k1"], columns["k2"]
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
    table = PerfectHash(first[order[new]], second[order[new]])
    slot, depth = table.slots(first, second), columns["depth"]
    parent, level = (np.full(len(table), -1) for _ in range(2))
    within = (depth == 1) | ((depth > 1) & ((depth - 1) % segment != 0))
    parent[slot[within]] = table.slots(columns["p1"][within], columns["p2"][within])
    level[slot] = depth - (np.maximum(depth, 1) - 1) // segment * segment
    leaves, saved = np.zeros(len(table), np.int64), np.zeros(len(table), np.int64)
    np.add.at(leaves, slot, columns["leaf"])
    np.add.at(saved, slot, columns["weight"])
    deepest_first = np.argsort(-level, kind="stable")
    edges = np.flatnonzero(np.diff(level[deepest_first])) + 1
    for some in np.split(deepest_first, edges):
        some = some[parent[some] >= 0]
        np.add.at(leaves, parent[some], leaves[some])
        np.add.at(saved, parent[some], saved[some])
    return table, leaves, saved


def _shard_sums(weighted: DataFrame, segment: int, block: int) -> DataFrame:
    """k1, k2, leaves, saved: the sums of each block of paths, in shards along first turns and owners."""
    names = ["k1", "k2", "p1", "p2", "depth", "leaf", "weight", "conv_id", "segment"]
    dealt = weighted.repartitionByRange("top", "conv_id", "segment").sortWithinPartitions("top", "conv_id", "segment", "depth")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def closed() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            table, *sums = subtree_sums({n: rows.column(n).fill_null(0).to_numpy() for n in names[:7]}, segment)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (table.first, table.second, *sums)], ["k1", "k2", "leaves", "saved"])

        for batch in batches:
            for at in range(0, len(batch), block):
                rows = batch.slice(at, block)
                conv, part = (rows.column(c).to_numpy() for c in (7, 8))
                if held and sum(map(len, held)) + len(rows) > block:
                    # The rows of an open segment stay together.
                    last = (held[-1].column(7)[-1].as_py(), held[-1].column(8)[-1].as_py())
                    same = (conv == last[0]) & (part == last[1])
                    n = len(same) if same.all() else int(np.argmin(same))
                    held.append(rows.slice(0, n))
                    rows = rows.slice(n)
                    if len(rows):
                        yield closed()
                        held = []
                if len(rows):
                    held.append(rows)
        if held:
            yield closed()

    return dealt.select(*names).mapInArrow(summed, "k1 bigint, k2 bigint, leaves bigint, saved bigint")


def _ends(paths: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256: a digest of the ids of the conversations that end at a node, which stream by in order."""
    ordered = paths.where("last").select(*_NODE, "conv_id").repartition(*_NODE).sortWithinPartitions(*_NODE, "conv_id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            first, second = (batch.column(c).to_numpy() for c in (0, 1))
            edges = [0, *(np.flatnonzero((np.diff(first) != 0) | (np.diff(second) != 0)) + 1).tolist(), len(first)]
            out = []
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if node != (first[a], second[a]):
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest, comma = (first[a], second[a]), hashlib.sha256(), ""
                digest.update((comma + ",".join(map(str, batch.column(2).slice(a, b - a).to_pylist()))).encode())
                comma = ","
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*_NODE, "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, digest.hexdigest())], [*_NODE, "ends_sha256"])

    return ordered.mapInArrow(hashed, "k1 bigint, k2 bigint, ends_sha256 string")


def prefix_trie(rows: DataFrame, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """A row for each node of the trie of `conversation_rows`: every distinct sequence of first turns, from the root on.

    conv_id (the smallest conversation that starts with it), depth, parent_conv_id (its
    parent's conv_id, null for the root), n_convs (conversations that start with it, those
    without turns at the root), n_children, n_leaves (childless nodes in its subtree,
    itself included), saved_tokens (over its subtree, conversations of each node
    but one times the bytes of its last text), ends_sha256 (of the comma-joined ids that
    end there, ascending). No conversation, no node. Repeated rows are repeated
    turns; texts of any length count as their key and size; further columns are ignored.
    """
    trace = stored(paths(rows), "paths")
    same = [F.min(c).alias(c) for c in ("conv_id", "depth", "p1", "p2", "bytes")]
    nodes = stored(trace.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_convs"), *same), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint"))
    nodes = stored(nodes, "nodes")
    owned = nodes.select(
        "conv_id", "depth", (F.col("n_children") == 0).cast("bigint").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("weight")
    )
    zero = F.lit(0).cast("bigint")
    weighted = trace.join(nodes.select("conv_id").distinct(), "conv_id", "left_semi").join(owned, ["conv_id", "depth"], "left")
    weighted = weighted.withColumn("segment", F.floor((F.greatest("depth", F.lit(1)) - 1) / segment))
    weighted = stored(weighted.withColumns({c: F.coalesce(c, zero) for c in ("leaf", "weight")}), "owners-paths")
    later = Window.partitionBy("conv_id").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    totals = weighted.groupBy("conv_id", "segment").agg(F.sum("leaf").alias("leaf"), F.sum("weight").alias("weight"))
    carried = totals.select("conv_id", ((F.col("segment") + 1) * segment).alias("depth"), F.sum("leaf").over(later).alias("leaf_on"), F.sum("weight").over(later).alias("weight_on"))
    weighted = weighted.join(carried.where("leaf_on IS NOT NULL"), ["conv_id", "depth"], "left")
    weighted = weighted.withColumns({c: F.col(c) + F.coalesce(c + "_on", zero) for c in ("leaf", "weight")})
    sums = _shard_sums(stored(weighted.drop("leaf_on", "weight_on"), "weights"), segment, block)
    sums = sums.groupBy(*_NODE).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    known = nodes.join(above, ["p1", "p2"], "left").join(sums, _NODE).join(_ends(trace), _NODE, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return known.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")
    )
