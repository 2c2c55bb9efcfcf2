import numpy as np
from helpers import frame, words

from terrace.llm import decontaminate as dc
from terrace.llm.common import Words, lowered, stripped_hashes

import random


def items(rng, n=40):
    return [(k, f"{words(rng, rng.randrange(12, 90), 900).capitalize()}. {words(rng, rng.randrange(5, 12), 900).capitalize()}.") for k in range(n)]


def test_wand_finds_what_scoring_all_finds():
    rng = random.Random(3)
    index = dc.Index(items(rng))
    draw = np.random.default_rng(1)
    for threshold in (0.05, 0.2, 0.5):
        for _ in range(40):
            query = np.sort(draw.choice(len(index.terms), 150, replace=False))
            scores = np.zeros(len(index.owner))
            for t in query:
                part = slice(*index.first[t : t + 2])
                scores[index.entry[part]] += index.weight[part]
            found = dict(index.retrieve(query, threshold))
            assert sorted(found) == np.flatnonzero(scores >= threshold).tolist()
            assert all(abs(scores[k] - s) < 1e-9 for k, s in found.items())


def test_question_and_answer():
    assert dc.parts("One two? Three four.") == ("One two?", " Three four.")
    assert dc.parts("one two three four five six") == ("one two three four", "five six")
    assert dc.parts("") == ("", "")


def test_contaminated_documents(spark):
    rng = random.Random(8)
    known = items(rng)
    pairs = [(k, words(rng, 300, 900)) for k in range(30)]
    pairs += [(100 + k, f"{words(rng, rng.randrange(200), 900)}\n{t.upper()} {words(rng, 90, 900)}") for k, t in known]
    one_word = known[0][1].split()
    one_word[3] = "changed"
    pairs += [(200, " ".join(one_word)), (201, known[1][1].rsplit(".", 2)[0]), (202, ""), (203, None), (202, "")]
    extra = spark.createDataFrame([*known, (None, known[2][1]), (90, ""), (91, None), known[5]], "item_id long, text string")
    got = dc.contaminated(frame(spark, pairs), extra).collect()
    found = {r.doc_id: r["items"] for r in got}
    assert len(got) == len(pairs)
    assert all(found[100 + k] == [k] for k, _ in known)
    assert all(not found[k] for k in [*range(30), 202, 203])
    # Against a search that compares every document with every item.
    index = dc.Index(known)
    for i, t in pairs:
        own = stripped_hashes(Words(lowered([(t or "").encode()])))
        whole = dc.shingles(own)
        held = [index.items[k][0] for k in range(len(known)) if len(own) and dc._held(index, k, own, whole, {})]
        assert found[i] == held
    # Several shards find the same; without items nothing is found.
    again = dc.contaminated(frame(spark, pairs), extra, shard_chars=2000).collect()
    assert {r.doc_id: r["items"] for r in again} == found
    none = dc.contaminated(frame(spark, pairs[:3]), extra.limit(0)).collect()
    assert [r["items"] for r in none] == [[], [], []]
    # A hot item repeated a thousand times is one entry; clashing columns are carried or replaced.
    hot = extra.union(spark.range(1000).selectExpr("5 AS item_id", f"'{known[5][1]}' AS text"))
    clashing = frame(spark, pairs).select("doc_id", "text").selectExpr("*", "1 AS score", "2 AS `items`", "3 AS version", "4 AS shard", "5 AS _row", "6 AS `a.b`")
    for chars in (dc.SHARD_CHARS, 4000):
        got = dc.contaminated(clashing, hot, shard_chars=chars).collect()
        assert {r.doc_id: r["items"] for r in got} == found and len(got) == len(pairs)
        assert {(r.version, r.shard, r["_row"], r["a.b"]) for r in got} == {(3, 4, 5, 6)}
        assert dc.contaminated(clashing.limit(0), hot, shard_chars=chars).count() == 0


def test_long_text(spark):
    rng = random.Random(5)
    known = items(rng, 6)
    text = f"{words(rng, 300_000, 900)} {known[4][1]} {words(rng, 20, 900)}"
    for chars in (dc.SHARD_CHARS, 1500):
        got = dc.contaminated(frame(spark, [(1, text)]), spark.createDataFrame(known, "item_id long, text string"), shard_chars=chars).collect()
        assert [r["items"] for r in got] == [[4]]


def test_bounds_by_block():
    index = dc.Index(items(random.Random(4), 60))
    dense = np.zeros((len(index.terms), index.blocks))
    term = np.repeat(np.arange(len(index.terms)), np.diff(index.first))
    np.maximum.at(dense, (term, index.entry // dc.BLOCK), index.weight)
    draw = np.random.default_rng(2)
    terms = [draw.choice(len(index.terms), k, replace=False) for k in (1, 7, 90)]
    got = index.best_blocks(np.concatenate(terms), np.repeat(np.arange(3), [1, 7, 90]), 3)
    assert np.allclose(got, [dense[t].sum(axis=0).max() for t in terms])
    assert all(index.block_bounds(t) == {b: dense[t, b] for b in np.flatnonzero(dense[t])} for t in range(len(dense)))
