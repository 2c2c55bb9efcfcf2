"""Best-fit packing of tokenised documents into sequences, improved by swaps.

Pieces are dealt at random to groups of bounded size. A group is packed by
best fit decreasing; then its underfull bins exchange pieces one for one, two
for one or by moving one, whenever that raises the sum of squared fills, so
that the fullest fill up and the emptiest drain until they disappear. The bins
that stay underfull are few per group; they are dealt anew and packed again.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stored

CAPACITY = 2048
END = 0  # the id that closes each document
GROUP = 5_000  # pieces packed together: what a task holds at once
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256


class Encoder:
    """Token ids of the 50k byte-level vocabulary, read from its file of ranks.

    The JSON file of the same vocabulary names the vocabulary; the faster
    reader of its ranks gives the same ids (held against each other in tests),
    also for the special string inside a text.
    """

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(vocabulary.removesuffix(".json").removesuffix(".tiktoken") + ".tiktoken", "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self._tokens = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID}
        )

    def __call__(self, text: str) -> list[int]:
        if SPECIAL in text:
            return self._tokens.encode(text, allowed_special="all")
        return self._tokens.encode_ordinary(text)


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all full but perhaps the first."""
    first = n % capacity or capacity
    edges = [0, *range(min(first, n), n + 1, capacity)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): every document's ids and a closing 0, cut."""
    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), END], dtype="<u4")
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start : start + length]
                    rows.append((doc, k, start, length, zlib.crc32(part.tobytes())) + ((part.astype(np.int32),) if with_ids else ()))
            columns = list(zip(*rows)) if rows else [()] * (5 + with_ids)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names[: len(columns)])

    return docs.select("doc_id", "text").mapInArrow(tokenised, kinds)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    room: list[int] = []  # distinct free spaces, ascending
    having: dict[int, list[int]] = defaultdict(list)
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        at = bisect_left(room, lengths[i])
        if at == len(room):
            bins.append([])
            b, free = len(bins) - 1, capacity
        else:
            free = room[at]
            b = having[free].pop()
            if not having[free]:
                del having[free], room[at]
        bins[b].append(i)
        left = free - lengths[i]
        if left:
            if left not in having:
                insort(room, left)
            having[left].append(b)
    return bins


def swapped(bins: list[list[int]], lengths: list[int], capacity: int, rounds: int = 4) -> list[list[int]]:
    """Swap-based local search over all underfull bins; full ones stay as they are.

    A step takes an underfull bin as giver and one at least as full as taker: it moves
    a piece, or exchanges one for one or two for one, so that the taker gains.
    Moving fill from a bin to a fuller one raises the sum of squared fills, so
    the search ends; a bin without pieces disappears. The takers of a piece are
    looked for among all pieces at once, kept in arrays.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    done = [b for b, f in zip(bins, fill) if f == capacity]
    work = [list(b) for b, f in sorted(zip(bins, fill), key=lambda x: x[1]) if f < capacity]
    for _ in range(rounds):
        work.sort(key=lambda b: sum(lengths[i] for i in b))
        room = np.array([capacity - sum(lengths[i] for i in b) for b in work], np.int64)
        pieces = np.array([i for b in work for i in b], np.int64)
        length = np.array([lengths[i] for i in pieces], np.int64)
        place = {int(i): k for k, i in enumerate(pieces)}
        holder = np.repeat(np.arange(len(work)), [len(b) for b in work])
        gained = False
        for g, giver in enumerate(work):
            # Each step at most once for a piece of the giver, so that a round stays short.
            for _ in range(len(giver)):
                step = _step(g, giver, lengths, room, pieces, length, holder)
                if not step:
                    break
                out, back, taker = step
                for i, to in [(i, taker) for i in out] + [(i, g) for i in back]:
                    work[holder[place[i]]].remove(i)
                    work[to].append(i)
                    room[holder[place[i]]] += lengths[i]
                    room[to] -= lengths[i]
                    holder[place[i]] = to
                gained = True
        work = [b for b in work if b]
        if not gained:
            break
    return done + work


def _step(
    g: int, giver: list[int], lengths: list[int], room: np.ndarray, pieces: np.ndarray, length: np.ndarray, holder: np.ndarray
) -> tuple[list[int], list[int], int] | None:
    """The exchange that moves most out of the giver: pieces out of it, pieces back, the taker's number."""
    may = room <= room[g]
    may[g] = False
    if not may.any():
        return None
    best, step = 0, None
    rooms = np.where(may, room, 0)
    for a in giver:
        if best < lengths[a] <= rooms.max():
            # The fullest bin that has room for it.
            at = np.where(rooms >= lengths[a], rooms, np.iinfo(np.int64).max).argmin()
            best, step = lengths[a], ([a], [], int(at))
    # A piece comes back for what is at most its bin's room longer.
    able = np.flatnonzero(may[holder] & (room[holder] > best))
    if not len(able):
        return step
    back, top = length[able], length[able] + room[holder[able]]
    offers = sorted({lengths[a]: [a] for a in giver}.items())
    few = sorted(giver, key=lambda a: (lengths[a], a))[:24]
    both = {lengths[a] + lengths[b]: [a, b] for k, a in enumerate(few) for b in few[:k]}
    for size, out in [*offers, *sorted(both.items())]:
        gain = np.where(size <= top, size - back, 0)
        at = int(gain.argmax())
        if gain[at] > best:
            best, step = int(gain[at]), (out, [int(pieces[able[at]])], int(holder[able[at]]))
    return step


def _packed(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    group = group.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], ascending=[False, True, True, True, True], ignore_index=True)
    lengths = group["length"].tolist()
    bins = swapped(best_fit(lengths, capacity), lengths, capacity)
    bins.sort(key=lambda b: -sum(lengths[i] for i in b))
    number, offset, fill = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
    for k, b in enumerate(bins):
        place = 0
        for i in b:
            number[i], offset[i] = k, place
            place += lengths[i]
        fill[b] = place
    return group.assign(bin=number, offset=offset, fill=fill)


def _packer(names: list[str], capacity: int, group: int, last: bool):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        # What chance dealt beyond `group` pieces is packed in equal parts.
        parts, first = max(1, -(-len(frame) // group)), 0
        dealt = []
        for k in range(parts):
            out = _packed(frame[names + ["g"]].iloc[k::parts], capacity)
            # At most half the pieces go on, those of the emptiest bins (bins are numbered by fill).
            behind = len(out) - np.searchsorted(np.sort(out["bin"]), out["bin"])
            out["open"] = (out["fill"] < capacity - capacity // 50) & (2 * behind <= len(out)) & (not last)
            out["bin"] += first
            first = out["bin"].max() + 1
            dealt.append(out)
        return pd.concat(dealt)[names + ["g", "bin", "offset", "fill", "open"]]

    return pack


def _can_combine(left: DataFrame, capacity: int) -> bool:
    """Whether fewer bins could hold the open ones' pieces, and a piece or a bin fits into another bin."""
    bins = left.where("offset = 0").agg(F.count(F.lit(1)).alias("n"), F.sum("fill").alias("fill")).first()
    if bins.n <= -(-(bins.fill or 0) // capacity):
        return False
    low = [r.fill for r in left.where("offset = 0").select("fill").orderBy("fill").limit(2).collect()]
    shortest = left.agg(F.min("length")).first()[0]
    return sum(low) <= capacity or shortest + low[0] <= capacity


def packed(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The pieces with sequence_id and offset: whole pieces, gapless from 0, at most `capacity` long.

    `pieces` must be a written table: groups are dealt by a hash of the row's
    place in it, so a length, a document or a repeated row that makes up a third
    of all pieces is spread evenly, and a task run again deals alike. No group has more than `group` pieces.
    The bins a group cannot fill (at most one in fifty of a full sequence left free counts as filled) are dealt
    anew to fewer groups, the emptiest first and at most half of a group's pieces, so each level has at most half the
    pieces of the one before. Levels end when what is open fits one group, or when no open bins can be combined.
    Repeated rows are pieces of their own; an empty table gives an empty result.
    """
    kinds = pieces.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    names = pieces.columns
    left, done, level, first = pieces, [], 0, 0
    total = pieces.count()
    while True:
        last = total <= group
        # A twentieth less on average, so that chance rarely deals a group too many.
        groups = 1 if last else -(-total * 20 // (group * 19))

        dealt = left.withColumn("g", F.pmod(F.xxhash64(F.lit(level), F.monotonically_increasing_id()), F.lit(groups)).cast("int"))
        at = dealt.groupBy("g").applyInPandas(_packer(names, capacity, group, last), f"{kinds}, g int, bin bigint, offset bigint, fill bigint, open boolean")
        at = at.withColumn("numbered", F.lit(first).cast("bigint") + F.col("g"))
        if last:
            done.append(at)
            break
        at = stored(at, f"packed-{level}")
        left = at.where("open")
        if left.isEmpty() or not _can_combine(left, capacity):
            done.append(at)
            break
        done.append(at.where("not open"))
        left = left.select(*names)
        total, level, first = left.count(), level + 1, first + groups
    whole = done[0]
    for more in done[1:]:
        whole = whole.union(more)
    # Groups are numbered through all levels; a group has fewer than 2^24 bins.
    return whole.select(*names, (F.col("numbered") * (1 << 24) + F.col("bin")).alias("sequence_id"), "offset")


def packed_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, group: int = GROUP, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    A null or empty text is one piece of the closing id alone. Documents longer
    than the capacity, and only they, are cut: all pieces but perhaps the first
    are full. Further columns are ignored.
    """
    pieces = stored(token_pieces(docs, vocabulary, capacity, with_ids), "pieces")
    return packed(pieces, capacity, group)
