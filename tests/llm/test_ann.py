import numpy as np
import pytest

from terrace.llm import ann

SCHEMA = "vec_id long, embedding array<float>, rank string, n1 string, vector int"


def frame(spark, pairs):
    return spark.createDataFrame([(i, v, "x", "y", 3) for i, v in pairs], SCHEMA)


def plain(rows, k):
    """Every query row against every other row; products are summed from first to last."""
    rows = [(i, np.float64(np.float32(v))) for i, v in rows]
    out = []
    for at, (i, v) in enumerate(rows):
        if i % 20:
            continue
        far = sorted((-float(np.cumsum(v * w)[-1]), j) for o, (j, w) in enumerate(rows) if o != at)
        out += [(i, rank, j, -f) for rank, (f, j) in enumerate(far[:k], 1)]
    return sorted(out)


def found(spark, pairs, k=20):
    table = frame(spark, pairs)
    return sorted(map(tuple, ann.neighbours(table, table.where("vec_id % 20 = 0"), k).collect()))


def test_pairs_come_by_falling_sum():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=9), np.round(rng.normal(size=7), 1)
    got = list(ann.pairs_by_sum(a, b))
    assert sorted((i, j) for i, j, _ in got) == [(i, j) for i in range(9) for j in range(7)]
    sums = [s for _, _, s in got]
    assert sums == sorted(sums, reverse=True) and np.allclose(sums, [a[i] + b[j] for i, j, _ in got])


def test_ties_copies_and_rows_without_part(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=6).tolist()) for i in range(1, 90)]
    good += [(i, good[19][1]) for i in range(200, 260)]  # more copies of one vector than neighbours asked for
    good += [(300 + i, np.round(rng.normal(size=6)).tolist()) for i in range(40)]  # equal scores
    good = [(i, v) for i, v in good if any(v)]
    bad = [(20, None), (40, []), (60, [0.0] * 6), (80, [1.0, None] + [0.0] * 4), (400, [float("nan")] * 6), (420, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    got = found(spark, good + bad)
    want = plain(good, 20)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == [r[3] for r in want]


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (20, [3.0, 1.0]), (7, [-1.0, 0.5])]
    assert found(spark, rows) == plain(rows, 20)
    assert found(spark, rows[:1]) == [] and found(spark, []) == [] and found(spark, [(20, None)]) == []
    # Shorter vectors are filled with zeros; of rows that repeat, the other one is a candidate.
    assert found(spark, [(0, [1.0]), (1, [2.0, 5.0])]) == [(0, 1, 1, 2.0)]
    assert found(spark, [(0, [1.0]), (0, [1.0])]) == [(0, 1, 0, 1.0)]


@pytest.mark.parametrize("hot", [False, True])
def test_recall(spark, hot, monkeypatch):
    """Both walks, several pieces of a shard; a third of the rows around one point."""
    monkeypatch.setattr(ann, "NEAR", 200)
    monkeypatch.setattr(ann, "PIECE", 64)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 16))
    if hot:
        vectors[:1000] = vectors[0] + 0.05 * rng.normal(size=(1000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got, want = found(spark, rows), plain(rows, 20)
    assert len(got) == len(want)
    exact = {r[:1] + r[2:] for r in want}
    assert sum((r[0], r[2], r[3]) in exact for r in got) >= 0.95 * len(want)
