import hashlib
import random
import re
from collections import Counter
from math import exp, log1p

from helpers import frame

from terrace.llm import pii

# The four forms as they are defined, matched by another engine.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(FORMS)


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), KINDS.index(kind), m.end()))
    return ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e in sorted(out))


TEXTS = [
    "a@b.c+d@e.f and .x@y-z.co.uk. x@y x@.y @a.b a@b..c", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 1.2.3 999.9.9.9.1.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1111 1111 0 5 12", "+1 (555) 555-1234 +49 30 123456) +1 +12345 +1234567890123456",
    "é😀 q@w.e 😀 +12345678901 ü 8.8.8.8", "", None, "   ", "9" * 5000, "1 " * 20_000, "a." * 20_000 + "@b", "a@" + "b." * 6000 + "c", "+1" + "2(" * 9000,
]


def test_fixed_forms(spark):
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, TEXTS[1])])).collect()}
    assert len(got) == len(TEXTS) + 1
    for i, text in enumerate(TEXTS):
        wanted = base(text or "")
        assert got[i].base_sha256 == hashlib.sha256(wanted.encode()).hexdigest(), (text, got[i].spans)
        assert [got[i][f"n_{k}"] for k in KINDS] == [wanted.count(k + ":") for k in KINDS]
        if not got[i].n_found:
            assert got[i].spans == wanted
    assert pii.personal_data(frame(spark, [])).count() == 0


def test_contexts_find_more(spark):
    pairs = [(k, f"Some words. phone: +1 (555) 555-10{k:02d} and more") for k in range(6)]
    pairs += [(50, "call phone: 555 123 4567 today"), (51, "the number 555 123 4567 in a sum"), (52, "year 2001-2003 of it")]
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, pairs)).collect()}
    assert (got[50].spans, got[50].n_found, got[50].n_phone) == ("phone:12:24", 1, 0)
    assert got[51].n_found == got[52].n_found == got[0].n_found == 0


def test_contexts_of_discovered_instances_and_glued_contexts_count(spark):
    pairs = [(k, f"dial +1 555 000 {1000 + k}") for k in range(20)] + [(100 + k, f"dial 555-10{k}0") for k in range(5)]
    pairs += [(200 + k, f"ring 555-10{k}0") for k in range(5)] + [(300, "ring 555-7777")]  # `ring` never meets a fixed form
    pairs += [(400 + k, f"tel:+1 555 111 {1000 + k}") for k in range(20)] + [(500, "tel:555-8888"), (600, "about 555-9999")]
    found = {r.doc_id: r.n_found for r in pii.personal_data(frame(spark, pairs)).collect()}
    assert (found[100], found[300], found[500], found[600]) == (1, 1, 1, 0)


def confident(met, texts):
    """The patterns that hold, scored one by one in plain Python from the matches (rows) and the texts."""
    n, seeds, words = Counter(), {}, Counter()
    spans = {doc_id: [] for doc_id in texts}
    for m in met:
        if m.kind is None:
            continue
        spans[m.doc_id].append((m.start, m.end))
        for side in ("left", "right"):
            if (m.holds or not m.base) and m[side]:
                n[m.kind, side, m[side], m.match] += 1
                seeds[m.kind, m.match] = seeds.get((m.kind, m.match), False) or m.holds
    for doc_id, text in texts.items():
        held = list(text)
        for a, e in spans[doc_id]:
            held[a:e] = " " * (e - a)
        words.update("".join(held).lower().split())
    beside = Counter()
    for (kind, side, word, _), k in n.items():
        beside[kind, side, word] += k
    total = {word: max(words[word], *(k for (_, _, w), k in beside.items() if w == word)) for _, _, word in beside}
    score, sure = {i: float(s) for i, s in seeds.items()}, {}
    for _ in range(pii.ROUNDS):
        good, support = Counter(), Counter()
        for (kind, side, word, match), k in n.items():
            good[kind, side, word] += k * score[kind, match]
            support[kind, side, word] += score[kind, match] > pii.CONFIDENT
        sure = {p: min(1.0, good[p] / total[p[2]]) for p in good if support[p] >= pii.SUPPORT}
        for kind, match in score:
            held = [min(0.999999, sure[k, s, w]) for k, s, w, m in n if (k, m) == (kind, match) and (k, s, w) in sure]
            score[kind, match] = 1.0 if seeds[kind, match] else 1 - exp(sum(log1p(-x) for x in held))
    return {p for p in sure if sure[p] >= pii.CONFIDENT}


def test_scores_of_patterns_against_plain_python(spark):
    rng = random.Random(6)
    drawn = []
    for k in range(400):
        number = f"+1 555 {rng.randrange(30):03} {1000 + rng.randrange(20)}" if rng.random() < 0.3 else f"555-{rng.randrange(1000, 1040)}"
        mail = f"u{rng.randrange(25)}@{'x.org' if rng.random() < 0.5 else 'host'}"
        found = rng.choice([number, mail, "nothing"])
        drawn.append((k, f"Pre {rng.choice(['tel', 'ring', 'fax', 'the', 'of', 'write'])} {found} {rng.choice(['now', 'or', 'the', 'of', 'ask'])} end the of"))
    docs = frame(spark, drawn)
    met = pii.stored(pii.occurrences(docs), "identifiers")
    wanted = confident(met.collect(), dict(drawn))
    got = {(r.kind, r.side, r.word) for r in pii.patterns(met, docs).collect()}
    assert got == wanted and 0 < len(wanted) < 40
