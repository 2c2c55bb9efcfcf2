"""Small texts, and plain versions of the operators to hold them against."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, row string, version int, node string"


def frame(spark, pairs):
    """Documents with further columns named like inner ones of the operators."""
    rows = [(i, t, "en", "s", "x", 1, "y") for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def corpus(seed=1, n=60):
    """Random texts, exact and near copies, shared passages, ties, nulls, empties, a very long text."""
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(1, 120)) for _ in range(n)]
    passage = words(rng, 50)
    texts = list(base)
    texts += [base[0], base[0], base[1] + "\n"]
    texts += [t + "\n" + passage + "\n" + words(rng, 20) for t in base[2:6]]
    for t in base[6:10]:
        changed = t.split()
        changed[len(changed) // 2] = "changed"
        texts.append(" ".join(changed))
    texts += ["", None, "   ", "word", "same " * 200, words(rng, 5000), "é😀 " * 50, "line\n\nline\n \nline"]
    pairs = list(enumerate(texts))
    return pairs + [pairs[0], (None, base[3]), (None, base[3]), (7, "another text of an id seen before")]


def union_find(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


ASCII_WORD = re.compile("[^\x20\x09-\x0d]+")
