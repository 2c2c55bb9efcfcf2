import hashlib
import random
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import corpus, frame

from terrace.llm import alignment as al

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = ["</s> <s>", "a<|endoftext|>b <unk> [INST]", "x <0x0A> y", "▁", "a▁b", "tab\tnl\n\n  two", "  ", "é😀漢字 ‍", "\x00\x01", "0123456789" * 30, "ﬁ Ⅳ ①"]


def loaded():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_of_letter():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def tokens(first, second, text):
    letters = byte_of_letter()
    ids = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    bytes_a = [bytes(letters[c] for c in first.id_to_token(k)) for k in ids[0]]
    bytes_b = [bytes([int(second.id_to_piece(k)[3:5], 16)]) if second.is_byte(k) else second.id_to_piece(k).replace("▁", " ").encode() for k in ids[1]]
    both = (" " + text).encode()
    if not text or b"".join(bytes_a) != both or b"".join(bytes_b) != both:
        return [], [], [], []
    return *ids, np.cumsum([*map(len, bytes_a)]).tolist(), np.cumsum([*map(len, bytes_b)]).tolist()


def plain(pairs):
    first, second = loaded()
    held, counts = [], Counter()
    for doc, text in pairs:
        a, b, ends_a, ends_b = tokens(first, second, text or "")
        links = [
            (x, y)
            for i, x in enumerate(a)
            for j, y in enumerate(b[bisect_right(ends_b, ends_a[i - 1] if i else 0) :], bisect_right(ends_b, ends_a[i - 1] if i else 0))
            if (ends_b[j - 1] if j else 0) < ends_a[i]
        ]
        groups, i, j = [], 0, 0
        for end in sorted({*ends_a} & {*ends_b}):
            up_a, up_b = bisect_right(ends_a, end), bisect_right(ends_b, end)
            groups.append(f"{','.join(map(str, a[i:up_a]))}|{','.join(map(str, b[j:up_b]))}")
            i, j = up_a, up_b
        counts.update(links)
        held.append((doc, a, b, links, groups))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(
        (
            (doc, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for doc, a, b, links, groups in held
        ), key=str,
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_aligned(spark):
    pairs = [(i, t) for i, t in corpus(n=25) if t is None or len(t) < 9000]
    pairs += [(500 + k, t) for k, t in enumerate(ODD)]
    got = al.aligned(frame(spark, pairs), A, B).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == plain(pairs)


def test_no_rows(spark):
    assert al.aligned(frame(spark, []), A, B).collect() == []
    empty = al.aligned(frame(spark, [(None, None), (1, "")]), A, B).select(*COLUMNS).collect()
    assert sorted(map(tuple, empty), key=str) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def test_groups(spark):
    rows = al.token_groups(frame(spark, [(1, "ab c"), (2, None)]), A, B).collect()
    first, second = loaded()
    assert {r.doc_id for r in rows} == {1, 2} and rows[1].groups == ""
    told = [g.split("|") for g in rows[0].groups.split(";")]
    assert ",".join(x for x, _ in told) == ",".join(map(str, first.encode(" ab c", add_special_tokens=False).ids))
    assert ",".join(y for _, y in told) == ",".join(map(str, second.encode("ab c")))


@pytest.mark.parametrize("work", [1, 2, 3, 7, 1000])
def test_pieces_of_a_merge_are_stitched(work):
    rng = np.random.default_rng(work)
    for _ in range(60):
        end = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, end + 1, rng.integers(1, end + 1)), end)) for _ in "ab")
        got = [x.tolist() for x in al.overlaps(a, b, work)]
        bounds = lambda x: list(zip([0, *x[:-1].tolist()], x.tolist()))
        links = [(i, j) for i, (s, e) in enumerate(bounds(a)) for j, (t, f) in enumerate(bounds(b)) if max(s, t) < min(e, f)]
        assert list(zip(got[0], got[1])) == links
        assert got[2] == [bool(a[i] == b[j]) for i, j in links]
        i, j = al.diagonals(a, b, work)
        assert (np.diff(i + j)[:-1] == work).all() and (i[-1], j[-1]) == (len(a), len(b))


def test_both_readers_of_the_byte_vocabulary_agree():
    first, _ = loaded()
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab 'é\n\t1<|endoftext|>😀") for _ in range(rng.randrange(80))) for _ in range(300)]
    assert [x.tolist() for x in al.vocabulary(A)(texts)] == [first.encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_a_very_long_text(spark):
    text = " ".join(random.Random(6).choice(["one", "two", "thrée", "x" * 40]) for _ in range(150_000))
    row = al.aligned(frame(spark, [(1, text)]), A, B).first()
    assert row.n_a >= 150_000 and row.n_links >= max(row.n_a, row.n_b) and row.n_groups >= 100_000
