"""Language identification by Bayesian fusion of evidence.

Each row may have a text, a language its markup declares, an address and with
it a suffix, a host and a domain. The text's likelihood comes from byte
trigrams; what markup and suffix tell is learned by grouped aggregation over all rows, as is a prior
for each host, smoothed towards its domain and that towards all rows. All are
multiplied: posterior ~ host prior * P(text) * P(declared) * P(suffix).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import lowered, pieces, stored, text_or_empty

CLASSES = 1 << 16  # of trigrams by hash
SAMPLE = 5_000  # labelled documents of each language the trigrams are counted in, at most about this many
MASS = 40.0  # a text counts as at most this many independent trigrams
STRENGTH = 10.0  # rows a domain, or all rows, count for in the prior of a host


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the trigrams of each text, blanks around words included, and bounds. Trigrams across texts are left out."""
    joined = np.frombuffer(b"".join(b" " + t + b" " for t in lowered(texts)), np.uint8).astype(np.int64)
    lengths = np.fromiter((len(t) for t in lowered(texts)), np.int64, len(texts)) + 2
    joined[(joined < 0x41) & (joined >= 0)] = 0x20  # digits and ASCII punctuation tell nothing
    code = ((joined[:-2] * 961 + joined[1:-1]) * 1021 + joined[2:]) % CLASSES
    blank = (joined[:-2] == 0x20) & (joined[1:-1] == 0x20) | (joined[1:-1] == 0x20) & (joined[2:] == 0x20)
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(texts)), lengths)[:-2]
    good = ~blank & (np.arange(len(code)) + 2 < ends[doc])
    return code[good], np.searchsorted(doc[good], np.arange(len(texts) + 1))


class Trigrams:
    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        self.table = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32) if len(languages) else np.zeros((CLASSES, 0), np.float32)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Tempered log likelihoods, a row for each text; zeros for a text without letters."""
        code, bounds = _trigrams(texts)
        sums = np.zeros((len(code) + 1, len(self.languages)))
        np.cumsum(self.table[code], axis=0, out=sums[1:])
        n = np.maximum(1, np.diff(bounds))[:, None]
        mean = (sums[bounds[1:]] - sums[bounds[:-1]]) / n
        return mean * np.minimum(n, MASS)


def train(docs: DataFrame, sample: int = SAMPLE) -> Trigrams:
    """Count trigrams in about `sample` documents of each language, chosen by a hash of the row.

    The languages are those of all labelled rows with a text, however rare; without any no language is known.
    The model has a column of CLASSES numbers for each, so its size follows the languages, not the rows.
    """
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each language
    languages = sorted(r.lang for r in sizes)
    number = {lang: k for k, lang in enumerate(languages)}
    if not languages:
        return Trigrams([], np.zeros((0, CLASSES)))
    shares = docs.sparkSession.createDataFrame([(r.lang, int(min(1.0, sample / r.n) * (1 << 20))) for r in sizes], "lang string, share bigint")
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(1 << 20))
    chosen = known.join(F.broadcast(shares), "lang").where(drawn < F.col("share"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array([number[x] for x in batch.column(0).to_pylist()])
            for part, texts in pieces(batch):
                code, bounds = _trigrams(texts)
                at, n = np.unique(np.repeat(langs[part], np.diff(bounds)) * CLASSES + code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], ["at", "n"])

    table = chosen.select("lang", "text").mapInArrow(counted, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(languages) * CLASSES)
    counts[table["at"].to_numpy()] = table["n"].to_numpy()
    return Trigrams(languages, counts.reshape(len(languages), CLASSES))


_NO_TEXT = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"


def page_rows(pages: DataFrame) -> DataFrame:
    """page_id, text, declared, host, domain, suffix of web pages (url, html)."""
    html = text_or_empty("html")
    host = F.lower(F.regexp_extract(text_or_empty("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    declared = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return pages.select(
        "page_id", F.regexp_replace(html, _NO_TEXT, " ").alias("text"), declared.alias("declared"), host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"), F.regexp_extract(host, r"\.([a-z]+)$", 1).alias("suffix"),
    )


def document_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the document's source in the place of a host; the label it comes with is what is declared."""
    nothing = F.lit("")
    return docs.select(
        "doc_id", text_or_empty().alias("text"), F.lower(text_or_empty("lang")).alias("declared"), text_or_empty("source").alias("host"),
        nothing.alias("domain"), nothing.alias("suffix"),
    )


def _soft(table: DataFrame, key: str, n: int) -> DataFrame:
    """Per value of a column the summed text posteriors of its rows: a map-side combined aggregation."""
    return table.groupBy(key).agg(*[F.sum(F.get("post", F.lit(k))).alias(f"n{k}") for k in range(n)])


def identified(rows: DataFrame, model: Trigrams, label: str) -> DataFrame:
    """The columns of rows but text, declared, host, domain and suffix, then lang, probability, text_lang.

    rows: text, declared, host, domain, suffix, empty where unknown (null counts
    as empty), and any further columns. Unknown evidence tells nothing. A row
    without any evidence has the prior over all rows. Ties go to the
    alphabetically first language; lang is null only if no language is known at all. Repeated rows
    count as often as they occur; texts of any length are read whole. Columns named like a
    result column are replaced, all others may have any name; an empty table gives no rows.
    """
    context = rows.sparkSession.sparkContext
    shared, n = context.broadcast(model), len(model.languages)
    evidence = ["declared", "host", "domain", "suffix"]
    plain = [c for c in rows.columns if c not in ("text", *evidence, "lang", "probability", "text_lang")]
    if n == 0:
        nothing = F.lit(None).cast("string")
        return rows.select(*plain, nothing.alias("lang"), F.lit(None).cast("double").alias("probability"), nothing.alias("text_lang"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                scores = shared.value.scores(texts)
                post = np.exp(scores - scores.max(axis=1, keepdims=True))
                post /= post.sum(axis=1, keepdims=True)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), n).cast(pa.list_(pa.float64())) for v in (scores, post)]
                kept = [batch.column(batch.schema.get_field_index(c)).slice(part.start, len(texts)) for c in ("given", *evidence)]
                yield pa.RecordBatch.from_arrays([*kept, *lists], ["given", *evidence, "score", "post"])

    # Columns of rows travel in one, so that their names cannot clash.
    given = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in plain]).alias("given")
    filled = rows.select(given, *[text_or_empty(c).alias(c) for c in evidence], "text")
    kinds = filled.select("given", *evidence).schema.add("score", T.ArrayType(T.DoubleType())).add("post", T.ArrayType(T.DoubleType()))
    table = stored(filled.mapInArrow(scored, kinds), f"language-{label}")
    totals = [f"n{k}" for k in range(n)]
    # The prior over all rows: one row.
    everything = [float(x or 0.0) for x in table.agg(*[F.sum(F.get("post", F.lit(k))) for k in range(n)]).first()]
    base = [(x + 1.0) / (sum(everything) + n) for x in everything]
    all_of = F.array(*[F.lit(x) for x in base])

    def smoothed(soft: DataFrame, key: str, towards, name: str) -> DataFrame:
        size = sum((F.col(c) for c in totals), F.lit(0.0))
        parts = [((F.col(c) + STRENGTH * F.get(towards, F.lit(k))) / (size + STRENGTH)) for k, c in enumerate(totals)]
        return soft.select(key, F.array(*parts).alias(name))

    domains = smoothed(_soft(table.where("domain != ''"), "domain", n), "domain", all_of, "domain_prior")
    of_host = table.where("host != ''").groupBy("host").agg(F.max("domain").alias("domain"), *[F.sum(F.get("post", F.lit(k))).alias(f"n{k}") for k in range(n)])
    hosts = of_host.join(domains, "domain", "left").withColumn("towards", F.coalesce("domain_prior", all_of))
    hosts = smoothed(hosts.select("host", "towards", *totals), "host", F.col("towards"), "host_prior")

    def telling(key: str, name: str) -> DataFrame:
        """log P(value | language) up to what is common to all languages."""
        soft = _soft(table.where(F.col(key) != ""), key, n)
        parts = [F.log((F.col(c) + STRENGTH * base[k] / 100) / (everything[k] + STRENGTH)) for k, c in enumerate(totals)]
        return soft.select(key, F.array(*parts).alias(name))

    joined = table
    for found, key in ((hosts, "host"), (telling("declared", "by_markup"), "declared"), (telling("suffix", "by_suffix"), "suffix")):
        joined = joined.join(stored(found, f"language-{key}"), key, "left")
    zero = F.array(*[F.lit(0.0)] * n)
    total = [
        F.log(F.get(F.coalesce("host_prior", all_of), F.lit(k))) + F.get("score", F.lit(k))
        + F.get(F.coalesce("by_markup", zero), F.lit(k)) + F.get(F.coalesce("by_suffix", zero), F.lit(k))
        for k in range(n)
    ]
    names = F.array(*[F.lit(x) for x in model.languages])
    fused = joined.withColumn("total", F.array(*total)).withColumn("top", F.array_max("total"))
    mass = F.aggregate(F.transform("total", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, x: a + x)
    best = F.get(names, (F.array_position("total", F.col("top")) - 1).cast("int"))
    by_text = F.get(names, (F.array_position("post", F.array_max("post")) - 1).cast("int"))
    # Named before the columns of rows come back, among which there may be a total or a top.
    told = fused.select("given", best.alias("lang"), (1 / mass).alias("probability"), by_text.alias("text_lang"))
    return told.select(*[F.col("given").getField(c).alias(c) for c in plain], "lang", "probability", "text_lang")
