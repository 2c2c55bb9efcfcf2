import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import corpus, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.llm import packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def test_ids_are_those_of_the_tokenizer(tokenizer):
    encode = packing.encoder(VOCABULARY)
    texts = [t or "" for _, t in corpus()] + ["a<|endoftext|>b <|endoftext|>", "  two  \n\n blanks\t", "it's we'll 123 …", "　漢字 かな"]
    for text in texts:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_bins_hold_everything_once(lengths):
    bins = packing.best_fit(lengths, 50)
    better = packing.swapped(bins, lengths, 50)
    for packed in (bins, better):
        assert sorted(i for b in packed for i in b) == list(range(len(lengths)))
        assert all(0 < sum(lengths[i] for i in b) <= 50 for b in packed)
    squares = [sum(sum(lengths[i] for i in b) ** 2 for b in packed) for packed in (bins, better)]
    assert len(better) <= len(bins) and squares[1] >= squares[0]


def test_swaps_empty_a_bin():
    lengths = [6, 3, 5, 4, 2, 1, 5, 4]
    bins = [[0, 1], [2, 3], [4, 5], [6, 7]]  # 9, 9, 3, 9 of 10
    assert len(packing.swapped(bins, lengths, 10)) == 3


def test_cuts():
    assert packing.cuts(1, 8) == [(0, 1)] and packing.cuts(8, 8) == [(0, 8)]
    assert packing.cuts(9, 8) == [(0, 1), (1, 8)] and packing.cuts(24, 8) == [(0, 8), (8, 8), (16, 8)]


@pytest.mark.parametrize("group", [packing.GROUP, 20])
def test_documents_are_packed(spark, tokenizer, group):
    pairs = corpus()
    got = packing.packed_documents(frame(spark, pairs), VOCABULARY, 256, group).toPandas()
    ids = {}
    for i, t in pairs:
        ids.setdefault(i, []).append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
    total = sum(len(x) for several in ids.values() for x in several)
    assert got.length.sum() == total
    wanted = sorted(
        (-1 if i is None else i, k, a, n, zlib.crc32(np.array(x[a : a + n], "<u4").tobytes()))
        for i, several in ids.items() for x in several for k, (a, n) in enumerate(packing.cuts(len(x), 256))
    )
    rows = got.fillna({"doc_id": -1}).astype({"doc_id": int})[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert sorted(map(tuple, rows.to_numpy().tolist())) == wanted
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == (part.length.cumsum() - part.length).tolist() and part.length.sum() <= 256
    assert got.sequence_id.nunique() <= total / 256 * 1.05 + 2
    assert packing.packed_documents(frame(spark, []), VOCABULARY).count() == 0


def test_ids_can_be_kept(spark, tokenizer):
    got = packing.packed_documents(frame(spark, [(1, "some text"), (2, None)]), VOCABULARY, with_ids=True).collect()
    assert {r.doc_id: r.ids for r in got} == {1: [*tokenizer.encode("some text").ids, 0], 2: [0]}


def test_stages(spark, tmp_path):
    """Each stage on small tables: what must go goes, all else stays as it was."""
    import corpus_pipeline as pipeline

    rng = random.Random(6)

    def text(n):
        return " ".join(f"v{rng.randrange(3000)}" for _ in range(n))

    item, near = text(45) + ". " + text(6) + ".", text(200)
    pairs = [(k, f"{text(60)} u{k}") for k in range(60)]
    pairs += [(100 + k, f"{text(30)} stupid idiot {text(9)} stupid") for k in range(30)]
    pairs += [(200, near), (201, near.replace(near.split()[9], "other")), (202, near), (210, f"{text(40)} {item} {text(40)}")]
    pairs += [(220, "shared line of several words in a row\n" + text(50)), (221, text(50) + "\nshared line of several words in a row"), (230, ""), (231, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(100 <= i < 130)) for i, _ in pairs], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf, kept = str(tmp_path), docs
    left = {}
    for name, stage in pipeline.STAGES[:-1]:
        kept = pipeline.stored(stage(spark, kept, sf), "test")
        assert kept.columns == docs.columns
        left[name] = {r.doc_id: r.text for r in kept.collect()}
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "packing"]
    assert set(left["toxicity"]) == {i for i, _ in pairs if not 100 <= i < 130}
    assert 202 not in left["line dedup"] and left["line dedup"][221] == dict(pairs)[221].split("\n")[0]
    assert left["line dedup"][220] == dict(pairs)[220] and 230 in left["line dedup"] and 231 in left["line dedup"]
    assert len({200, 201} & set(left["near dedup"])) == 1
    assert set(left["near dedup"]) - set(left["decontamination"]) == {210}
    assert set(range(60)) <= set(left["decontamination"])
    packed = pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in packed} == set(left["decontamination"])
    empty = docs.limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_stages_carry_columns_of_any_name(spark, tmp_path):
    """Columns named like those the operators add come through as they were."""
    import corpus_pipeline as pipeline

    sf = "/root/testdata/sf0.01"
    names = ["n_lines", "n_removed", "severity", "toxic", "grade", "items", "score", "row", "version", "node", "root", "keep_id", "_row", "_others"]
    given = frame(spark, [(1, "one line\ntwo lines"), (2, "two lines\nthree of them"), (3, None)]).drop("row", "version", "node")
    given = given.withColumns({n: F.lit(f"own {n}") for n in names})
    for name, stage in pipeline.STAGES[:-1]:
        got = stage(spark, given, sf)
        assert got.columns == given.columns, name
        held = got.collect()
        assert held and all(r[n] == f"own {n}" for r in held for n in names), name


def test_near_dedup_stage_decides_by_row(spark):
    """Different texts under a null or repeated doc_id all stay; a near copy does not stay for its id's sake."""
    import corpus_pipeline as pipeline

    rng = random.Random(3)
    texts = [" ".join(f"v{rng.randrange(3000)}" for _ in range(150)) for _ in range(5)]
    near = texts[4].replace(texts[4].split()[70], "other")
    rows = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[3]), (5, texts[4]), (7, near), (None, near), (None, texts[0])]
    got = pipeline.drop_near_duplicates(spark, frame(spark, rows), "").collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), t) for i, t in [*rows[:4], rows[5]])
    again = pipeline.drop_near_duplicates(spark, frame(spark, [(5, texts[4]), (5, near)]), "").collect()
    assert len(again) == 1


def pieces_of(spark, lengths):
    rows = [(k, 0, 0, n, 0) for k, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")


@pytest.mark.parametrize("lengths", [[1500] * 300, [1500] * 150 + [300] * 150 + [1] * 5, [700] * 300])
def test_pieces_that_do_not_combine(spark, tmp_path, lengths):
    """Few levels whatever the lengths, groups of bounded size, and all pieces in the result."""
    pieces_of(spark, lengths).write.parquet(str(tmp_path / "p"))
    levels = []
    kept, packing.stored = packing.stored, lambda df, label: levels.append(label) or kept(df, label)
    try:
        got = packing.packed(spark.read.parquet(str(tmp_path / "p")), 2048, 2).collect()
    finally:
        packing.stored = kept
    assert sorted(r.doc_id for r in got) == list(range(len(lengths)))
    assert len(levels) <= 9
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 2048


def test_no_group_is_too_large_and_all_underfull_bins_are_searched():
    import pandas as pd

    frame = pd.DataFrame({"doc_id": range(50), "piece": 0, "start": 0, "length": 3, "ids_crc32": 0, "g": 0})
    seen, kept = [], packing._packed
    packing._packed = lambda group, capacity: seen.append(len(group)) or kept(group, capacity)
    try:
        out = packing._packer(["doc_id", "piece", "start", "length", "ids_crc32"], 9, 20, False)(frame)
    finally:
        packing._packed = kept
    assert max(seen) <= 20 and sorted(out.doc_id) == list(range(50))
    # 100 bins of 5 + 4 of 10, then 100 of 6 + 3; a 4 for a 3 fills one of each ten to the brim.
    lengths = [5, 4] * 100 + [6, 3] * 100
    bins = [[2 * k, 2 * k + 1] for k in range(200)]
    fills = [sum(lengths[i] for i in b) for b in packing.swapped(bins, lengths, 10)]
    assert sum(fills) == 1800 and fills.count(10) >= 100
