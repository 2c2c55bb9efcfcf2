import hashlib
from collections import Counter

import pytest
from helpers import ASCII_WORD, corpus, frame
from pyspark.sql import functions as F

from terrace.llm import exact, substring


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("hash_of", [F.xxhash64, lambda c: F.pmod(F.xxhash64(c), F.lit(3))])
def test_exact_duplicates(spark, hash_of):
    """Also when different chunks share a hash."""
    pairs = corpus()
    groups = {}
    for i, t in pairs:
        groups.setdefault(t or "", []).append(i)
    wanted = []
    for i, t in pairs:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None) if len(ids) > 1 else i
        wanted.append((i, keep, len(ids), i is not None and i == keep, sha(t or "")))
    got = [tuple(r) for r in exact.exact_duplicates(frame(spark, pairs), hash_of).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_chunks_join_to_the_text(spark):
    texts = ["", "a", "x" * 30_000, "Word after word, and so on. " * 900, "é😀\n" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", exact.chunks_of(F.col("t")).alias("c"))
    for r in df.collect():
        assert "".join(r.c) == texts[r.i]
        assert all(len(c) <= exact.MOST for c in r.c)


def test_nothing_in_nothing_out(spark):
    none = frame(spark, [])
    assert exact.exact_duplicates(none).count() == 0
    assert substring.without_repeats(none).count() == 0


def removed(pairs, window):
    told = [ASCII_WORD.findall(t or "") for _, t in pairs]
    seen = Counter(tuple(w[k : k + window]) for w in told for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(pairs, told):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("window, seed", [(35, 8), (6, 2)])
def test_repeats_go(spark, window, seed):
    pairs = corpus()
    got = [tuple(r) for r in substring.without_repeats(frame(spark, pairs), window, seed).collect()]
    assert sorted(got, key=str) == sorted(removed(pairs, window), key=str)
    assert sum(r[2] for r in got) > 100


def test_a_window_repeated_within_one_text(spark):
    part = " ".join(f"v{k}" for k in range(40))
    pairs = [(1, f"{part} between {part}"), (2, " ".join(f"v{k}" for k in range(34)))]
    got = {r.doc_id: r for r in substring.without_repeats(frame(spark, pairs)).collect()}
    assert (got[1].n_removed, got[1].kept) == (80, "between")
    assert got[2].n_removed == 0
