import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from terrace.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k1 int, part string"


def frame(spark, turns):
    return spark.createDataFrame([(*t, "x", 1, "y") for t in turns], SCHEMA)


def plain(conversations):
    """Nodes of a trie built one conversation after the other."""
    def node(parent, size):
        return {"parent": parent, "depth": parent["depth"] + 1 if parent else 0, "size": size, "members": [], "ends": [], "below": {}}

    root, nodes = node(None, 0), []
    for conv in sorted(conversations):
        at = root
        at["members"].append(conv)
        for turn in conversations[conv]:
            at = at["below"].setdefault(turn, node(at, len(turn[1].encode())))
            at["members"].append(conv)
        at["ends"].append(conv)
    nodes = [root]
    for at in nodes:
        nodes.extend(at["below"].values())
    for at in reversed(nodes):
        at["leaves"] = sum(b["leaves"] for b in at["below"].values()) or 1
        at["saved"] = (len(at["members"]) - 1) * at["size"] + sum(b["saved"] for b in at["below"].values())
    return sorted(
        (
            (n["members"][0], n["depth"], n["parent"]["members"][0] if n["parent"] else None, len(n["members"]), len(n["below"]), n["leaves"],
             n["saved"], hashlib.sha256(",".join(map(str, n["ends"])).encode()).hexdigest())
            for n in nodes if n["members"]
        ), key=str,
    )


def heard(turns):
    found = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            found[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v, key=lambda x: x[0])] for c, v in found.items()}


def rebuilt(said):
    heads = {c: zlib.crc32(str(c).encode()) % 9 for c in said}
    return {c: said.get(c - c % 5, [])[: heads[c]] + own[heads[c] :] for c, own in said.items()}


def conversations(seed=1, n=60):
    """Shared first turns, copies, conversations of one turn and of hundreds, nulls, empty texts."""
    rng = random.Random(seed)
    turns = []
    for conv in range(n):
        size = rng.choice([1, 2, 3, 5, 9, 12]) if conv % 17 else 150
        for k in range(size):
            told = f"turn {k}" if rng.random() < 0.8 else f"{rng.randrange(4)} é😀"
            turns.append((conv * 3 if conv % 2 else conv, k, ["user", "assistant"][k % 2], told))
    turns += [(1000 + c, k, "user", f"copy {k}") for c in range(40) for k in range(4)]
    turns += [(2001, None, None, None), (2001, 0, "user", ""), (2002, 0, "user", "x" * 300_000), (None, 0, "user", "no id")]
    return turns


def nodes(rows, **bounds):
    return sorted(map(tuple, trie.prefix_trie(rows, **bounds).collect()), key=str)


@pytest.mark.parametrize("bounds", [{}, {"segment": 7, "block": 50}])
def test_trie(spark, bounds):
    seen, turns = set(), []
    for t in conversations():
        if t[:2] not in seen or t[0] is None:
            seen.add(t[:2])
            turns.append(t)
    rows = trie.conversation_rows(frame(spark, turns))
    assert nodes(rows, **bounds) == plain(heard(turns))
    assert nodes(trie.with_shared_heads(rows), **bounds) == plain(rebuilt(heard(turns)))


def test_no_conversations_and_repeated_turns(spark):
    assert nodes(trie.conversation_rows(frame(spark, []))) == []
    assert nodes(trie.conversation_rows(frame(spark, [(None, 1, "user", "a")]))) == []
    twice = [(1, 1, "user", "a"), (1, 1, "user", "a"), (2, 1, "user", "a")]
    assert nodes(trie.conversation_rows(frame(spark, twice))) == plain(heard(twice))


def test_a_role_is_kept_apart_from_its_text(spark):
    turns = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc")]
    assert nodes(trie.conversation_rows(frame(spark, turns))) == plain(heard(turns))


def test_perfect_hash():
    rng = np.random.default_rng(7)
    first, second = rng.integers(-(1 << 63), 1 << 63, 5000), rng.integers(0, 3, 5000)
    first[:1000] = 5  # keys that differ in one half only
    second[:1000] = np.arange(1000)
    table = trie.PerfectHash(first, second)
    assert sorted(table.slots(first, second).tolist()) == list(range(5000)) and len(table) == 5000
    assert (table.slots(first + 1, second)[1000:] == -1).all()
    assert len(trie.PerfectHash(first[:0], second[:0])) == 0
