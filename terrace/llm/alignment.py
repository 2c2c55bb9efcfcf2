"""Alignment of the tokens of two tokenizers over the same text, and what is linked how often in the corpus.

A text's tokens end at byte offsets, in two ascending lists. Merging the lists
gives all links: between two ends next to each other lies exactly one pair of
tokens that overlap. The merge is cut into pieces of equal work: a binary search
along each diagonal of the merge path finds how much of either list lies before it, so
that every piece is merged by itself, with arrays of bounded size. An end that two
pieces share is dropped from the second; ends common to both lists close groups.

Texts are taken in batches of a few megabytes. A batch keeps its distinct id pairs
once, and for each text the numbers of its pairs. Pairs are counted over the corpus,
and the counts return to the batches that hold them; tokens are not moved.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import pieces, stored, text_or_empty

WORK = 1 << 16  # ends merged by a piece


class Vocabulary:
    """Ids of texts, and the bytes, lengths and decimal digits of each id."""

    def __init__(self, tokens: list[bytes], ids):
        self.tokens = tokens
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self._ids = ids
        told = [str(k).encode() for k in range(len(tokens))]
        width = len(told[-1])
        self.digits = np.frombuffer(b"".join(t.ljust(width + 1) for t in told), np.uint8).reshape(len(told), width + 1)
        self.n_digits = np.fromiter(map(len, told), np.int64, len(told))

    def __len__(self) -> int:
        return len(self.tokens)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return self._ids(texts)

    def joined(self, ids: np.ndarray) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[k] for k in ids.tolist()])


def byte_level(path: str) -> Vocabulary:
    """A byte-level vocabulary by its file of ranks, beside the JSON file of the same name; a space is put before the text."""
    import public_tokenizers
    import tiktoken

    with open(path.removesuffix(".json").removesuffix(".tiktoken") + ".tiktoken", "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return Vocabulary(tokens, lambda texts: [np.asarray(encoding.encode_to_numpy(" " + t), np.int64) for t in texts])


def piece_level(path: str) -> Vocabulary:
    """A vocabulary of pieces with byte fallback, whose model puts the space before the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    named = [(model.id_to_piece(k), model.is_byte(k)) for k in range(model.get_piece_size())]
    tokens = [bytes([int(p[3:5], 16)]) if as_byte else p.replace("▁", " ").encode() for p, as_byte in named]
    return Vocabulary(tokens, lambda texts: [np.asarray(ids, np.int64) for ids in model.encode(texts, num_threads=1)])


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = piece_level(path) if path.endswith(".model") else byte_level(path)
    return _loaded[path]


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """How much of a and of b lies before each `work`-th step of their merge, with equal values of a first."""
    step = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(0, step - len(b)), np.minimum(step, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        takes = a[np.minimum(middle, len(a) - 1)] <= b[np.clip(step - middle - 1, 0, len(b) - 1)]
        low, high = np.where(open_ & takes, middle + 1, low), np.where(open_ & ~takes, middle, high)
    return low, step - low


def overlaps(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each link its token in a and in b, and whether both end where it ends. a and b are ends, ascending, with the same last."""
    first, second = diagonals(a, b, work)
    found, before = [], -1
    for i, up_a, j, up_b in zip(first, first[1:], second, second[1:]):
        ends = np.sort(np.concatenate((a[i:up_a], b[j:up_b])), kind="stable")
        ends = ends[np.diff(ends, prepend=before) != 0]
        if not len(ends):
            continue
        before = ends[-1]
        of_a, of_b = i + np.searchsorted(a[i:up_a], ends), j + np.searchsorted(b[j:up_b], ends)
        found.append((of_a, of_b, (a[of_a] == ends) & (b[of_b] == ends)))
    return tuple(map(np.concatenate, zip(*found))) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool))


class Aligned:
    """The tokens of some texts and their links. Texts that either vocabulary does not give back unchanged have none."""

    def __init__(self, texts: list[bytes], a: Vocabulary, b: Vocabulary, work: int = WORK):
        plain = [t.decode() for t in texts]
        ids_a, ids_b = a(plain), b(plain)
        for k, text in enumerate(texts):
            if not text or a.joined(ids_a[k]) != b" " + text or b.joined(ids_b[k]) != b" " + text:
                ids_a[k] = ids_b[k] = np.zeros(0, np.int64)
        self.a, self.b = a, b
        self.n_a, self.n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        self.ids_a, self.ids_b = (np.concatenate([np.zeros(0, np.int64), *ids]) for ids in (ids_a, ids_b))
        # Texts stand one behind the other, so that all texts end in both lists.
        self.ends_a, self.ends_b = np.cumsum(a.lengths[self.ids_a]), np.cumsum(b.lengths[self.ids_b])
        self.of_a, self.of_b, self.common = overlaps(self.ends_a, self.ends_b, work)
        self.bounds_a, self.bounds_b = (np.concatenate(([0], np.cumsum(n))) for n in (self.n_a, self.n_b))
        self.bounds = np.searchsorted(self.of_a, self.bounds_a)

    def n_links(self) -> np.ndarray:
        return np.diff(self.bounds)

    def n_groups(self) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(self.common)))[self.bounds])

    def pairs(self) -> np.ndarray:
        """One number for the two ids of each link."""
        return self.ids_a[self.of_a] * len(self.b) + self.ids_b[self.of_b]

    def groups(self) -> list[bytes]:
        """Of each text its groups, as `a1,a2|b1;a3|b2,b3`."""
        closing = self.ends_a[self.of_a[self.common]]
        in_a, in_b = np.searchsorted(closing, self.ends_a), np.searchsorted(closing, self.ends_b)
        # A group's tokens of a come first, then those of b.
        place_a = np.arange(len(in_a)) + np.searchsorted(in_b, in_a)
        place_b = np.arange(len(in_b)) + np.searchsorted(in_a, in_b, side="right")
        n, comma, bar, semicolon = len(in_a) + len(in_b), *b",|;"
        digits = np.zeros((n, max(self.a.digits.shape[1], self.b.digits.shape[1])), np.uint8)
        size = np.zeros(n, np.int64)
        for place, ids, own, of, last in ((place_a, self.ids_a, self.a, in_a, bar), (place_b, self.ids_b, self.b, in_b, semicolon)):
            digits[place, : own.digits.shape[1]] = own.digits[ids]
            size[place] = own.n_digits[ids]
            ended = np.append(np.diff(of) != 0, True)[: len(of)]
            digits[place, own.n_digits[ids]] = np.where(ended, last, comma)
        written = digits[np.arange(digits.shape[1]) <= size[:, None]].tobytes()
        edges = np.concatenate(([0], np.cumsum(size + 1)))[self.bounds_a + self.bounds_b]
        return [written[s : e - 1] if e > s else b"" for s, e in zip(edges[:-1].tolist(), edges[1:].tolist())]


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32 as bytes, like places together, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


_BATCH = {
    "batch": pa.int64(), "doc_id": pa.list_(pa.int64()), "n_a": pa.list_(pa.int64()), "n_b": pa.list_(pa.int64()),
    "n_groups": pa.list_(pa.int64()), "n_links": pa.list_(pa.int64()), "groups_sha256": pa.list_(pa.string()),
    "n_held": pa.list_(pa.int64()), "held": pa.binary(), "times": pa.binary(), "pairs": pa.list_(pa.int64()), "counts": pa.list_(pa.int64()),
}
_BATCH_SQL = ", ".join(f"{n} " + {"int64": "bigint", "binary": "binary"}.get(str(t), "array<string>" if n == "groups_sha256" else "array<bigint>") for n, t in _BATCH.items())


def _batches(docs: DataFrame, a: str, b: str) -> DataFrame:
    """A row for each batch of texts: figures of each text, distinct pairs with counts, and which of them each text holds."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = vocabulary(a), vocabulary(b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, texts in pieces(batch):
                own = Aligned(texts, first, second)
                digests = [hashlib.sha256(g).hexdigest() if g else "" for g in own.groups()]
                pairs, index, counts = np.unique(own.pairs(), return_inverse=True, return_counts=True)
                doc = np.repeat(np.arange(len(texts)), own.n_links())
                held, times = np.unique(doc * max(1, len(pairs)) + index, return_counts=True)
                doc, held = held // max(1, len(pairs)), held % max(1, len(pairs))
                n_held = np.bincount(doc, minlength=len(texts))
                # Numbers ascend within a text; the steps between them are small.
                steps = np.diff(held, prepend=0)
                steps[(np.cumsum(n_held) - n_held)[n_held > 0]] = held[(np.cumsum(n_held) - n_held)[n_held > 0]]
                row = [
                    number, batch.column(0)[part].to_pylist(), own.n_a, own.n_b, own.n_groups(), own.n_links(), digests,
                    n_held, _packed(steps), _packed(times), pairs, counts,
                ]
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _BATCH.values())], list(_BATCH))

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(aligned, _BATCH_SQL)


def pair_counts(batches: DataFrame, second_ids: int) -> DataFrame:
    """pair, n, best: how many links of the corpus hold a pair of ids, and whether no pair with the same b has more."""
    each = batches.select(F.explode(F.arrays_zip("pairs", "counts")).alias("one"))
    counted = each.groupBy(F.col("one.pairs").alias("pair")).agg(F.sum("one.counts").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.col("pair") % second_ids))
    return counted.withColumn("best", F.col("n") == most)


def aligned(docs: DataFrame, a: str, b: str) -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best is the number of links whose pair is among the most frequent of its b id
    in the corpus (ties included), count_sum the corpus counts of all links. Null and
    empty texts, and those whose joined tokens differ from a space and the text,
    have no tokens: zeros and an empty digest. Strings of special tokens inside texts
    are plain text. Repeated rows are counted as often as they occur; further columns are
    ignored; an empty table gives no rows. A text is tokenised as a whole in one task.
    """
    taken = stored(_batches(docs, a, b), "token-pairs")
    size = len(vocabulary(b))
    counts = stored(pair_counts(taken.select("pairs", "counts"), size), "pair-counts")
    wanted = taken.select("batch", F.posexplode("pairs").alias("at", "pair")).join(counts, "pair")
    wanted = wanted.select("batch", F.struct("at", (2 * F.col("n") + F.col("best").cast("bigint")).alias("told")).alias("one"))
    told = wanted.groupBy("batch").agg(F.transform(F.sort_array(F.collect_list("one")), lambda x: x["told"]).alias("told"))
    figures = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    both = taken.select("batch", *figures, "n_held", "held", "times").join(told, "batch", "left")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1)
                told = row.column("told").flatten().to_numpy()
                n_held = row.column("n_held").flatten().to_numpy()
                steps, times = (_unpacked(row.column(c)[0].as_py()) for c in ("held", "times"))
                first = np.cumsum(n_held) - n_held
                places = np.cumsum(steps)
                places -= np.repeat(np.concatenate(([0], places))[first], n_held)
                sums = [np.concatenate(([0], np.cumsum(v))) for v in (times * (told[places] & 1), times * (told[places] >> 1))]
                new = [pa.array(s[first + n_held] - s[first]) for s in sums]
                yield pa.RecordBatch.from_arrays([*(row.column(c).flatten() for c in figures), *new], names)

    kinds = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"
    return both.select(*figures, "n_held", "held", "times", "told").mapInArrow(summed, kinds)


def token_groups(docs: DataFrame, a: str, b: str) -> DataFrame:
    """doc_id, groups: the aligned ids of each text, as `a1,a2|b1;a3|b2,b3`; empty for texts without tokens."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                own = Aligned(texts, vocabulary(a), vocabulary(b))
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], pa.array([g.decode() for g in own.groups()])], ["doc_id", "groups"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(told, "doc_id bigint, groups string")
