"""Near duplicates by consistent weighted sampling over TF-IDF shingles.

A document is a weighted set of shingles of five words. Improved consistent
weighted sampling draws HASHES samples of it such that two documents draw the
same with a probability equal to their weighted Jaccard similarity. Samples
are banded; documents that share a band are compared exactly, and those with
a weighted Jaccard similarity of at least SIMILAR are linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import Words, lowered, mixed, pieces, run_hashes, stored, text_or_empty
from terrace.llm.components import classes

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 8, 3  # finds a pair at the threshold with probability 0.997
CLASSES = 1 << 18  # of words by hash, for document frequencies: the size of what is broadcast


def word_weights(docs: DataFrame, n_classes: int = CLASSES) -> np.ndarray:
    """The inverse document frequency of each class of words, over all documents.

    Tasks count in arrays of n_classes, so one row per class and task is
    shuffled, and n_classes numbers reach the driver, whatever the data.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(n_classes, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, texts in pieces(batch):
                words = Words(lowered(texts))
                kind = (words.hash % np.uint64(n_classes)).astype(np.int64)
                once = np.unique(words.doc() * n_classes + kind)
                total += np.bincount(once % n_classes, minlength=n_classes)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(met, -1)), pa.array(np.append(total[met], n))], ["kind", "n"]
        )

    rows = docs.select("text").mapInArrow(counted, "kind bigint, n bigint").groupBy("kind").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    kind, n = table["kind"].to_numpy(), table["n"].to_numpy()
    counts = np.zeros(n_classes)
    counts[kind[kind >= 0]] = n[kind >= 0]
    everything = n[kind < 0].sum()
    return 1.0 + np.log((everything + 1.0) / (counts + 1.0))


def weighted(texts: list[bytes], weights: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes, their TF-IDF weights, and bounds per text; shingles of a text are distinct and ascending.

    A shingle is at most as frequent as its rarest word; that word's inverse
    document frequency is taken for it. A text of fewer words is one shingle.
    """
    words = Words(lowered(texts))
    n = np.diff(words.bounds)
    idf = weights[(words.hash % np.uint64(len(weights))).astype(np.int64)]
    count = np.where(n == 0, 0, np.maximum(n - size + 1, 1))
    doc = np.repeat(np.arange(len(texts)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + words.bounds[:-1][doc]
    end = np.minimum(start + size, words.bounds[1:][doc])
    shingle = run_hashes(words.hash, start, end)
    rarest = idf[start] if len(start) else np.zeros(0)
    for k in range(1, size if len(start) else 0):
        rarest = np.maximum(rarest, idf[np.minimum(start + k, end - 1)])
    order = np.lexsort((shingle, doc))
    shingle, doc, rarest = shingle[order], doc[order], rarest[order]
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(shingle)))
    bounds = np.searchsorted(doc[at], np.arange(len(texts) + 1))
    return shingle[at], times * rarest[at], bounds


def _uniform(z: np.ndarray) -> np.ndarray:
    """In (0, 1], from the upper 32 bits."""
    return ((z >> np.uint64(32)).astype(np.float64) + 1.0) * 2.0**-32


def samples(shingle: np.ndarray, weight: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """For each text (row) the n consistent weighted samples, as 64-bit values; 0 for a text without shingles."""
    out = np.zeros((len(bounds) - 1, n), np.uint64)
    some = np.flatnonzero(np.diff(bounds))
    if not len(some):
        return out
    # Blocks of whole texts, small enough for the processor's cache.
    at = 0
    while at < len(some):
        upto = max(at + 1, np.searchsorted(bounds[some], bounds[some[at]] + 32768))
        chosen = some[at:upto]
        low, high = bounds[chosen[0]], bounds[chosen[-1] + 1]
        s, log_w, first = shingle[low:high], np.log(weight[low:high]), bounds[chosen] - low
        lengths = np.diff(np.append(first, high - low))
        for k in range(n):
            z = mixed(s ^ np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF))
            y = mixed(z + np.uint64(0xD1B54A32D192ED03))
            x = mixed(y + np.uint64(0xD1B54A32D192ED03))
            r = -np.log(_uniform(z) * _uniform(z << np.uint64(32)))
            log_c = np.log(-np.log(_uniform(y) * _uniform(y << np.uint64(32))))
            beta = _uniform(x)
            t = np.floor(log_w / r + beta)
            log_a = log_c - r * (t - beta + 1.0)
            least = np.minimum.reduceat(log_a, first)
            hit = np.flatnonzero(log_a == np.repeat(least, lengths))
            owner = np.searchsorted(first, hit, side="right") - 1
            one = hit[np.unique(owner, return_index=True)[1]]
            out[chosen, k] = mixed(s[one] ^ t[one].astype(np.int64).astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD))
        at = upto
    return out


def signatures(docs: DataFrame, weights, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """the columns of docs but the text, and `bands`: a value for each band, none without words."""
    kept = [c for c in docs.columns if c != "text"]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                shingle, weight, bounds = weighted(texts, weights.value)
                drawn = samples(shingle, weight, bounds, bands * rows).reshape(len(texts) * bands, rows)
                number = np.tile(np.arange(1, bands + 1, dtype=np.uint64), len(texts))
                value = number
                for k in range(rows):
                    value = mixed(value ^ drawn[:, k])
                listed = value.view(np.int64).reshape(len(texts), bands)
                have = np.diff(bounds) > 0
                offsets = np.concatenate(([0], np.cumsum(have * bands)))
                found = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(listed[have].ravel(), pa.int64()))
                columns = [batch.column(batch.schema.get_field_index(c)).slice(part.start, len(texts)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, found], [*kept, "bands"])

    kinds = docs.select(*kept).schema.add("bands", T.ArrayType(T.LongType()))
    return docs.select(*kept, "text").mapInArrow(signed, kinds)


def verified(pairs: DataFrame, texts: DataFrame, weights, similar: float = SIMILAR) -> DataFrame:
    """The pairs a, b whose texts (node, text) have a weighted Jaccard similarity of at least `similar`."""
    first, second = (texts.select(F.col("node").alias(c), F.col("text").alias("text_" + c)) for c in "ab")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            other = batch.column(3).cast(pa.binary())
            for part, texts_a in pieces(batch, "text_a"):
                texts_b = [x.as_py() for x in other.slice(part.start, len(texts_a))]
                n = len(texts_a)
                shingle, weight, bounds = weighted(texts_a + texts_b, weights.value)
                pair = np.repeat(np.arange(2 * n) % n, np.diff(bounds))
                order = np.lexsort((shingle, pair))
                s, w, p = shingle[order], weight[order], pair[order]
                both = np.flatnonzero((s[1:] == s[:-1]) & (p[1:] == p[:-1]))
                common = np.bincount(p[both], np.minimum(w[both], w[both + 1]), minlength=n)
                total = np.bincount(p, w, minlength=n) - common
                holds = pa.array(common >= similar * total - 1e-9)
                yield pa.RecordBatch.from_arrays(
                    [a.slice(part.start, n).filter(holds), b.slice(part.start, n).filter(holds)], ["a", "b"]
                )

    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(compared, "a bigint, b bigint")


def _shingles(nodes: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """node, shingle, weight of the given nodes."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column(0).to_numpy()
            for part, held in pieces(batch):
                shingle, weight, bounds = weighted(held, weights.value)
                owner = np.repeat(node[part], np.diff(bounds))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner), pa.array(shingle.view(np.int64)), pa.array(weight)], ["node", "shingle", "weight"]
                )

    asked = texts.join(nodes, "node", "left_semi").select("node", "text")
    return asked.mapInArrow(listed, "node bigint, shingle bigint, weight double")


def text_hashes() -> list:
    """h1 and h2 of the column text; null is empty."""
    return [F.xxhash64(text_or_empty()).alias("h1"), F.xxhash64(F.lit(1), text_or_empty()).alias("h2")]


def decided(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The rows of `near_duplicates` with h1 and h2 of their text and root, which names the group."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", *text_hashes(), text_or_empty().alias("text"))
    weights = spark.sparkContext.broadcast(word_weights(rows))
    signed = stored(signatures(rows, weights), "signatures")
    # Equal texts are one node from here on: the hash of their text.
    nodes = signed.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(nodes.withColumn("node", F.xxhash64("h1", "h2")), "texts")
    members = signed.select(F.xxhash64("h1", "h2").alias("node"), F.explode("bands").alias("bucket")).distinct()
    shared = stored(members, "bands")
    several = shared.groupBy("bucket").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x != y")
    candidates = shared.join(several.select("bucket"), "bucket", "left_semi").select("node").distinct()
    # The text of one row for each, found by the id the rows' hashes were seen with.
    key = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key")
    wanted = nodes.join(candidates, "node").select("node", F.coalesce("least", F.lit(-(1 << 63))).alias("key"), "h1", "h2")
    texts = rows.select(key, "h1", "h2", "text").join(wanted.hint("shuffle_hash"), ["key", "h1", "h2"]).select("node", "text")
    texts = stored(texts.dropDuplicates(["node"]), "candidate-texts")

    def weighed(asked: DataFrame) -> DataFrame:
        return _shingles(asked, texts, weights)

    roots, links = classes(shared, lambda pairs: verified(pairs, texts, weights, similar), weighed, similar)
    degree = links.distinct().select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(degree, "node", "left")
    groups = placed.groupBy("root").agg(F.min("least").alias("keep_id"), F.sum("copies").alias("group_size"))
    judged = placed.join(groups, "root").select("h1", "h2", "root", "keep_id", "group_size", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return signed.select("doc_id", "h1", "h2").join(judged, ["h1", "h2"]).select(
        "doc_id", "h1", "h2", "root", "keep_id", "group_size", "n_links", kept
    )


def near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, n_links, kept.

    Words are compared in lower case. A group is what hangs together by links:
    equal texts, and texts whose weighted Jaccard similarity is at least
    `similar`; the smallest doc_id of a group stays. n_links counts the links
    verified between this text and others of its group. Null is the
    empty text; texts without words are near only to equal texts. Repeated rows
    are members of their group. A null doc_id takes part and never stays beside
    another; rows of a group without any doc_id all stay. An empty table gives an empty result; further columns are ignored.
    """
    return decided(docs, similar).select("doc_id", "keep_id", "group_size", "n_links", "kept")
