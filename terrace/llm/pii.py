"""Personal data by fixed forms, and more by bootstrapped contexts; DataFrame operations only.

Matches of the fixed forms are the seeds. The words before and after them are
lexical patterns. Looser forms give instances that may be identifiers as well;
patterns and instances make a graph, which is scored in rounds: a pattern is as
good as the share of its occurrences in the corpus that meet good instances, an
instance as good as its patterns together. Patterns above CONFIDENT that
met enough different seeds then mark the instances they occur with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import cut, stored, text_or_empty

# The four forms. Possessive groups match the same and need no
# stack; a start within a run of its characters is left out as it can't do better.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser forms of the same kinds: what an identifier may look like beside the form.
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++(?:@|\x20?(?:\(at\)|\[at\])\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}+(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z.+-])[0-9]{3,6}+(?:[\x20./-][0-9]{2,6}+){2,5}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.+-])\(?[0-9]{2,5}+\)?(?:[\x20./-][0-9]{2,5}+){1,4}+(?![0-9A-Za-z])",
}
KINDS = list(BASE)
ROUNDS = 3
SUPPORT = 3  # different seeds a pattern must have met
CONFIDENT = 0.5  # share of a pattern's occurrences


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(digits))
    doubled = F.transform(
        places,
        lambda i: F.when(
            (F.length(digits) - i) % 2 == 1,
            F.substr(digits, i, F.lit(1)).cast("int") * 2 - F.when(F.substr(digits, i, F.lit(1)) >= "5", 9).otherwise(0),
        ).otherwise(F.substr(digits, i, F.lit(1)).cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def occurrences(docs: DataFrame) -> DataFrame:
    """rid, doc_id and, for each match of any form, kind, base, start, end, match, left, right, holds.

    A text without matches has one row without a kind. `rid` numbers the rows of docs.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", text_or_empty().alias("text"))
    # A form is looked for only where what every match of it contains is there.
    number = F.col("text").rlike("[0-9]")
    signs = {
        "email_True": F.contains("text", F.lit("@")), "ip_True": number, "card_True": number, "phone_True": F.contains("text", F.lit("+")),
        "email_False": F.contains("text", F.lit("@")) | F.col("text").rlike(r"\(at\)|\[at\]"), "ip_False": F.contains("text", F.lit(":")),
        "card_False": number, "phone_False": number,
    }
    found = numbered.withColumn("signs", F.struct(*[c.alias(n) for n, c in signs.items()]))
    for base, forms in ((True, BASE), (False, LOOSE)):
        for kind, pattern in forms.items():
            name = f"{kind}_{base}"
            all_of = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
            found = found.withColumn(name, F.when(F.col(f"signs.{name}"), all_of).otherwise(F.array().cast("array<string>")))
    lists = []
    for base, forms in ((True, BASE), (False, LOOSE)):
        for kind, pattern in forms.items():
            lists.append(_listed(F.col(f"{kind}_{base}"), F.col("text"), kind, pattern, base))
    exploded = found.select("rid", "doc_id", F.explode_outer(F.concat(*lists)).alias("m")).select("rid", "doc_id", "m.*")
    earlier = Window.partitionBy("rid", "base", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    placed = exploded.repartition("rid").withColumn("end", F.sum(F.col("gap") + F.length("match")).over(earlier))
    placed = placed.withColumn("start", F.col("end") - F.length("match"))
    holds = F.when(F.col("kind").isNull(), F.lit(False))
    for k, kind in enumerate(KINDS):
        holds = holds.when(F.col("base") & (F.col("kind") == k), _holds(kind, F.col("match")))
    return placed.withColumn("holds", holds.otherwise(F.lit(False))).drop("gap", "no")


def _listed(found: Column, text: Column, kind: str, pattern: str, base: bool) -> Column:
    def one(pair: Column, i: Column) -> Column:
        before = pair["gap"]
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), F.lit(base).alias("base"), i.alias("no"),
            F.length(before).alias("gap"), pair["match"].alias("match"),
            F.lower(F.regexp_extract(F.right(before, F.lit(60)), r"(\S+)\s*$", 1)).alias("left"),
            F.lower(F.regexp_extract(F.left(pair["after"], F.lit(60)), r"^\s*(\S+)", 1)).alias("right"),
        )

    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(found.alias("match"), F.slice(gaps, 1, F.size(found)).alias("gap"), F.slice(gaps, 2, F.size(found)).alias("after"))
    listed = F.transform(zipped, one)
    nothing = "array<struct<kind:int,base:boolean,no:int,gap:int,match:string,left:string,right:string>>"
    return F.when(F.size(found) > 0, listed).otherwise(F.array().cast(nothing))


def _between(text: Column) -> Column:
    """The text with a blank for each match of any form, as what is next to a match ends there for contexts too."""
    for pattern in (*BASE.values(), *LOOSE.values()):
        text = F.regexp_replace(text, pattern, " ")
    return text


def patterns(met: DataFrame, docs: DataFrame) -> DataFrame:
    """kind, side, word of the patterns that hold: scored on the graph of patterns and instances."""
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("word")) for s in ("left", "right")])).alias("p")
    edges = met.where("holds or not base").select("kind", "match", "holds", sides).select("kind", "match", "holds", "p.side", "p.word")
    edges = stored(edges.where("word != ''").groupBy("kind", "side", "word", "match").agg(F.max("holds").alias("seed"), F.count(F.lit(1)).alias("n")), "pattern-graph")
    # How often each word occurs at all: over every word of every text, cut where contexts end. A word of
    # the graph that other forms' matches cover is at least where its own instances are.
    words = docs.select(F.explode(F.split(F.lower(_between(text_or_empty())), r"\s+")).alias("word")).groupBy("word").count()
    own = edges.groupBy("word", "kind", "side").agg(F.sum("n").alias("n")).groupBy("word").agg(F.max("n").alias("n"))
    total = F.greatest("n", F.coalesce("count", F.lit(0))).alias("total")
    totals = stored(own.join(words, "word", "left").select("word", total), "context-words")
    known = edges.groupBy("kind", "match").agg(F.max("seed").alias("seed"))
    score = cut(known.select("kind", "match", F.col("seed").cast("double").alias("s"), "seed"))
    key = ["kind", "side", "word"]
    scored = None
    for _ in range(ROUNDS):
        weighed = edges.drop("seed").join(score, ["kind", "match"])
        scored = weighed.groupBy(*key).agg(F.sum(F.col("n") * F.col("s")).alias("good"), F.sum((F.col("s") > CONFIDENT).cast("int")).alias("support"))
        scored = scored.join(totals, "word").select(*key, F.least(F.lit(1.0), F.col("good") / F.col("total")).alias("sure"), "support")
        scored = cut(scored.where(F.col("support") >= SUPPORT))
        through = edges.join(scored, key).groupBy("kind", "match").agg((1 - F.exp(F.sum(F.log1p(-F.least(F.lit(0.999999), "sure"))))).alias("through"))
        score = cut(score.join(through, ["kind", "match"], "left").select("kind", "match", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("through", F.lit(0.0))).alias("s"), "seed"))
    return scored.where(F.col("sure") >= CONFIDENT).select(*key)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found.

    The counts and base_sha256 are of the fixed forms; spans has those and what
    the contexts found (n_found of them, never overlapping a fixed form), as
    kind:start:end in code points, by start and then kind. A null text is
    empty; repeated rows get equal results, each its own; an empty table gives
    an empty result; further columns are ignored.
    """
    met = stored(occurrences(docs), "identifiers")
    sure = patterns(met, docs)
    loose = met.where("not base").withColumn("p", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("word")) for s in ("left", "right")])))
    more = loose.select("rid", "kind", "start", "end", F.col("p.side").alias("side"), F.col("p.word").alias("word")).join(sure, ["kind", "side", "word"])
    more = more.groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("more"))
    span = F.struct("start", "kind", "end")
    counts = [F.count(F.when(F.col("holds") & (F.col("kind") == k), 1)).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    base = met.groupBy("rid", "doc_id").agg(*counts, F.array_sort(F.collect_list(F.when(F.col("holds"), span))).alias("fixed"))
    both = base.join(more, "rid", "left")
    free = F.filter(F.col("more"), lambda m: ~F.exists("fixed", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    both = both.withColumn("more", F.coalesce(free, F.slice("fixed", 1, 0)))
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    return both.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(joined(F.col("fixed")), 256).alias("base_sha256"),
        joined(F.array_sort(F.array_union("fixed", "more"))).alias("spans"), F.size("more").cast("bigint").alias("n_found"),
    )
