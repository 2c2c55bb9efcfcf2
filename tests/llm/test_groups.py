"""Components, near duplicates and fuzzy lines against plain versions."""

import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
from helpers import corpus, frame, union_find, words

from pyspark.sql import functions as F

from terrace.llm import lines, neardup
from terrace.llm.components import _ranked, classes, components
from terrace.session import shared_folder


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(k, k + 1) for k in range(1000, 1012)]
    links += [(2000, k) for k in range(1990, 2010)] + [(5, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {k: v for k, v in union_find((a, b) for a, b in links if a != b).items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_samples_agree_as_often_as_texts_are_similar():
    rng = random.Random(2)
    base = [f"w{k}" for k in range(300)]
    other = list(base)
    for k in rng.sample(range(300), 12):
        other[k] = f"new{k}"
    shingle, weight, bounds = neardup.weighted([" ".join(base).encode(), " ".join(other).encode()], np.ones(1 << 10))
    sets = [dict(zip(shingle[a:b].tolist(), weight[a:b])) for a, b in zip(bounds, bounds[1:])]
    common = sum(min(w, sets[1].get(s, 0)) for s, w in sets[0].items())
    similar = common / (sum(sets[0].values()) + sum(sets[1].values()) - common)
    drawn = neardup.samples(shingle, weight, bounds, 600)
    assert abs((drawn[0] == drawn[1]).mean() - similar) < 0.06


def near_groups(pairs, weights):
    texts = sorted({t or "" for _, t in pairs})
    sets = []
    for t in texts:
        s, w, _ = neardup.weighted([t.encode()], weights)
        sets.append(dict(zip(s.tolist(), w)))
    links = []
    for a in range(len(texts)):
        for b in range(a):
            common = sum(min(w, sets[b].get(s, 0)) for s, w in sets[a].items())
            total = sum(sets[a].values()) + sum(sets[b].values()) - common
            if total and common >= neardup.SIMILAR * total - 1e-9:
                links.append((a, b))
    roots = union_find(links)
    groups = {}
    for i, t in pairs:
        k = texts.index(t or "")
        groups.setdefault(roots.get(k, k), []).append(i)
    return {i: sorted(x for x in ids if x is not None) for ids in groups.values() for i in ids if i is not None}


def test_near_duplicates(spark):
    rng = random.Random(9)
    pairs = corpus()
    base = words(rng, 150).split()
    for k in range(15):  # copies of one text, some of them far from each other
        copy = list(base)
        for _ in range(rng.randrange(8)):
            copy[rng.randrange(150)] = f"c{k}x{rng.randrange(99)}"
        pairs.append((1000 + k, " ".join(copy)))
    docs = frame(spark, [p for p in pairs if p[0] != 7])
    weights = neardup.word_weights(docs)
    wanted = near_groups([p for p in pairs if p[0] != 7], weights)
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(pairs) - 2
    for r in got:
        if r.doc_id is not None:
            assert (r.keep_id, r.group_size >= len(wanted[r.doc_id])) == (wanted[r.doc_id][0], True), r
    assert neardup.near_duplicates(frame(spark, [])).count() == 0


def shingles(line):
    """Five characters from every place, in lower case, the line feed being the last; a shorter line as a whole."""
    ended = line.lower() + "\n"
    return {ended[k : k + lines.SHINGLE] for k in range(len(ended) - lines.SHINGLE + 1)} or {ended}


def plain_lines(pairs):
    """doc_id -> text left, for texts with different ids."""
    first, sets = {}, {}
    for i, t in pairs:
        for k, line in enumerate((t or "").split("\n")):
            if line.strip():
                first.setdefault(line, []).append((i, k))
                sets.setdefault(line, shingles(line))
    links = [
        (a, b) for a in sets for b in sets
        if a < b and len(sets[a] & sets[b]) >= lines.SIMILAR * len(sets[a] | sets[b])
    ]
    roots = union_find(links)
    groups = {}
    for line in sets:
        groups.setdefault(roots.get(line, line), []).extend(first[line])
    stays = {min(g) for g in groups.values()}
    out = {}
    for i, t in pairs:
        told = (t or "").split("\n")
        out[i] = "\n".join(x for k, x in enumerate(told) if not x.strip() or (i, k) in stays)
    return out


def test_lines(spark):
    rng = random.Random(4)
    long = words(rng, 40)
    pairs = [p for p in dict(corpus()).items() if p[0] is not None]
    pairs += [(500, long), (501, "head\n" + long.replace(long.split()[20], "other")), (502, long.upper()), (503, "a\nb\na\n\na")]
    pairs += [(504, "x" * 400), (505, "x" * 399 + "y"), (506, "unbroken" * 40 + "a"), (507, "unbroken" * 40 + "b")]
    pairs += [(508, "abcdefgh"), (509, "zabcdefgh"), (510, "mnopqrstuvw"), (511, "mnopqrstuvwx"), (512, "kurz"), (513, "kurze")]
    got = lines.without_repeated_lines(frame(spark, pairs))
    assert got.columns[:2] == ["doc_id", "lang"] and "node" in got.columns
    assert {r.doc_id: r.text for r in got.collect()} == plain_lines(pairs)
    assert lines.without_repeated_lines(frame(spark, [])).count() == 0


def test_similar_short_lines_are_found(spark):
    """Lines of 5 to 20 characters and copies with one more at an end, which reach 0.8 from 9 shingles on at the latest."""
    rng = random.Random(9)
    near, pairs = [], []
    for k in range(400):
        line = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(7, 20)))
        copy = rng.choice("0123456789") + line
        a, b = shingles(line), shingles(copy)
        if len(a & b) >= lines.SIMILAR * len(a | b):
            near.append(1000 + k)
        pairs += [(k, line), (1000 + k, copy)]
    assert len(near) > 380
    left = {r.doc_id: r.text for r in lines.without_repeated_lines(frame(spark, pairs)).collect()}
    assert sum(left[k] == "" for k in near) >= 0.99 * len(near) and all(left[k] for k in range(400))


def test_texts_of_one_short_hash_are_told_apart(spark):
    """Texts whose 32-bit hashes agree, under one id and under none, keep their own lines and words."""
    from terrace.llm import substring

    drawn = spark.range(400_000).select(F.concat_ws(" ", *[F.hash("id", F.lit(k)) for k in range(40)]).alias("t"))
    twins = drawn.groupBy(F.hash("t").alias("h")).agg(F.collect_list("t").alias("ts")).where("size(ts) > 1").first().ts
    got = {r.text for r in lines.without_repeated_lines(frame(spark, [(5, twins[0]), (7, twins[0]), (7, twins[1])])).collect()}
    assert got == {twins[0], "", twins[1]}
    left = substring.without_repeats(frame(spark, [(None, twins[0]), (None, twins[1]), (1, twins[0])])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in left) == [("1", 40), ("None", 0), ("None", 40)]


def test_repeated_rows_keep_the_same_lines(spark):
    got = lines.without_repeated_lines(frame(spark, [(1, "a line\nb line"), (1, "a line\nb line"), (None, None), (2, "b line\nc")])).collect()
    assert sorted((str(r.doc_id), r.text, r.n_removed) for r in got) == [("1", "a line\nb line", 0), ("1", "a line\nb line", 0), ("2", "c", 1), ("None", "", 0)]


def test_lines_with_one_letter_changed_are_found(spark):
    """Copies that reach 0.8 on the character shingles of all places go, also of ordinary length."""
    rng = random.Random(8)
    size, pairs, near = lines.SHINGLE, [], []
    for k in range(300):
        n = rng.randrange(50, 160)
        line = ""
        while len(line) < n:
            line += "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) + " "
        line = line[:n].strip()
        at = rng.randrange(len(line))
        copy = line[:at] + "#" + line[at + 1 :]
        a, b = ({t[i : i + size] for i in range(len(t) - size + 1)} for t in (line, copy))
        if len(a & b) >= lines.SIMILAR * len(a | b):
            near.append(1000 + k)
        pairs += [(k, line), (1000 + k, copy)]
    assert len(near) > 250
    left = {r.doc_id: r.text for r in lines.without_repeated_lines(frame(spark, pairs)).collect()}
    assert all(left[k] for k in range(300))
    assert sum(left[k] == "" for k in near) >= 0.98 * len(near)


def test_ranked_writes_what_a_set_can_be_found_by(spark):
    """Of the shingles only those a similar set must share one of, and one of each set; the sets are deleted."""
    shared = Path(shared_folder(spark))
    shared.mkdir(parents=True, exist_ok=True)
    before = set(shared.glob("*"))
    sets = [(node, s, 1.0) for node in range(1, 6) for s in range(20)] + [(6, 100 + s, 1.0) for s in range(20)]
    prefixes, centrality = _ranked(spark.createDataFrame(sets, "node long, shingle long, weight double"), 0.8)
    found = sorted((r.node, r.shingle, r.before, r.size) for r in prefixes.collect())
    assert found == [(node, s, float(s), 20.0) for node in range(1, 6) for s in range(5)]
    told = {r.node: r.shared for r in centrality.collect()}
    assert told == pytest.approx({**{node: math.log(5) for node in range(1, 6)}, 6: 0.0})
    left = set(shared.glob("*")) - before
    assert [p.name.split("-")[0] for p in left] == ["ranked"]
    assert spark.read.parquet(str(left.pop())).count() == 5 * 5 + 1


def test_line_dedup_deletes_what_is_not_read_any_more(spark):
    """Of its tables are left those the result reads, and the few links; pairs of unlike lines are told by their sketches."""
    shared = Path(shared_folder(spark))
    shared.mkdir(parents=True, exist_ok=True)
    before = set(shared.rglob("*.parquet"))
    rng = random.Random(3)
    long = ["".join(rng.choice("abcdefgh ") for _ in range(400)) for _ in range(3)]
    texts = [*long, long[0][:200] + "#" + long[0][201:]]
    got = lines.without_repeated_lines(frame(spark, list(enumerate(texts)))).collect()
    assert sorted(r.doc_id for r in got if r.text) == [0, 1, 2]
    left = {p.relative_to(shared).parts[0].rsplit("-", 5)[0].split("-")[0] for p in set(shared.rglob("*.parquet")) - before}
    assert left <= {"line", "found", "links"}
    signed = lines._signed(spark.createDataFrame(list(enumerate(texts)), "node long, line string")).collect()
    bits = {r.node: [r[f"bits_{k}"] for k in range(lines.WORDS)] for r in signed}
    apart = lambda a, b: sum(bin((x ^ y) & ((1 << 64) - 1)).count("1") for x, y in zip(bits[a], bits[b]))
    sets = [shingles(t) for t in texts]
    for a in range(4):
        for b in range(a):
            assert apart(a, b) <= len(sets[a] ^ sets[b])
    assert apart(3, 0) < 20 and apart(1, 0) > (len(sets[0]) + len(sets[1])) / 9


def test_union_find_joins_a_long_chain_and_leaves_one_table(spark):
    """The smallest node of a chain is the root of all of it; only the roots are left of the rounds' tables."""
    shared = Path(shared_folder(spark))
    shared.mkdir(parents=True, exist_ok=True)
    before = set(shared.glob("*"))
    order = list(range(40))
    random.Random(2).shuffle(order)
    links = [*zip(order, order[1:]), (100, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{node: 0 for node in range(40)}, 100: 100, 101: 100}
    assert [p.name.split("-")[0] for p in set(shared.glob("*")) - before] == ["found"]
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_sketches_tell_long_lines_apart(spark):
    """Pairs of long unlike lines are dropped by their sketches, near copies never."""
    rng = random.Random(5)
    long = ["".join(rng.choice("abcdefgh ") for _ in range(1800)) for _ in range(4)]
    near = [t[:300] + "#" + t[301:] for t in long]
    signed = lines._signed(spark.createDataFrame(list(enumerate(long + near)), "node long, line string"))
    a, b = (signed.drop("line").toDF(*[f"{c}_{x}" for c in signed.drop("line").columns]) for x in "ab")
    able = a.join(b, lines._able(lines.SIMILAR)).where("node_a < node_b").select("node_a", "node_b").collect()
    assert sorted(map(tuple, able)) == [(k, k + 4) for k in range(4)]


def test_lines_are_found_in_passes(spark, monkeypatch):
    """Each line stays in the first document that has it or a near copy, in however many passes the tables are written."""
    monkeypatch.setattr(lines, "PASS_ROWS", 10)
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(90)).strip() for _ in range(30)]
    chosen = [[rng.randrange(30) for _ in range(3)] for _ in range(40)]
    docs = frame(spark, [(k, "\n".join(base[x] + rng.choice(["", "x"]) for x in xs)) for k, xs in enumerate(chosen)])
    firsts = [len(set(xs) - {x for other in chosen[:k] for x in other}) for k, xs in enumerate(chosen)]
    assert {r.doc_id: 3 - r.n_removed for r in lines.without_repeated_lines(docs).collect()} == dict(enumerate(firsts))


def test_copies_in_a_large_bucket_of_lines_are_not_paired_with_each_other(spark):
    """The first star, around a line unlike all others, links none; the pairs compared stay in proportion to the copies."""
    copies, asked = 400, []

    def similar(pairs):
        asked.append(pairs.count())
        return pairs.where("a > 0")

    def weighed(nodes):
        shingle = F.when(F.col("node") == 0, F.lit("alone")).otherwise(F.lit("common"))
        return nodes.select("node", shingle.alias("shingle"), F.lit(1.0).alias("weight"))

    members = spark.range(copies + 1).select(F.lit(7).cast("long").alias("bucket"), F.col("id").alias("node"))
    roots, _ = classes(members, similar, weighed, lines.SIMILAR, lines.SMALL)
    assert {r.root for r in roots.where("node > 0").collect()} == {1} and roots.where("node > 0").count() == copies
    assert sum(asked) <= 3 * copies, asked
