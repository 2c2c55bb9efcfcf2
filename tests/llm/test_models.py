"""Language and toxicity on held-out rows of the small tables."""

import tracemalloc

import numpy as np
import pytest
from helpers import frame
from pyspark.sql import functions as F

from terrace.llm import language, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_of_held_out_documents(spark, docs):
    known = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    model = language.train(known)
    rest = docs.join(known.select("doc_id"), "doc_id", "left_anti")
    bare = language.document_rows(rest).withColumns({c: F.lit("") for c in ("declared", "host")})
    found = language.identified(bare, model, "t").join(rest.select("doc_id", F.col("lang").alias("y")), "doc_id").collect()
    assert np.mean([r.lang == r.y for r in found]) > 0.97
    assert all(0 < r.probability <= 1.000001 for r in found)


def test_evidence_beside_the_text_counts(spark, docs):
    model = language.train(docs)
    rows = [(k, "Die ist und der enkeit schung verber.", "de", "a.b.de", "b.de", "de") for k in range(40)]
    rows += [(100 + k, "the of thing and oned with thest", "en", "x.b.org", "b.org", "org") for k in range(40)]
    rows += [(200, "", "de", "", "", ""), (201, None, None, "a.b.de", None, None), (202, "1 2 3", "", "new.b.de", "b.de", ""), (203, "", "", "", "", "")]
    given = spark.createDataFrame(rows, "page_id long, text string, declared string, host string, domain string, suffix string")
    found = {r.page_id: r for r in language.identified(given, model, "t").collect()}
    assert len(found) == 84
    assert [found[k].lang for k in (0, 100, 200, 201, 202)] == ["de", "en", "de", "de", "de"]
    assert found[201].probability > 0.8 and found[203].lang in model.languages
    assert language.identified(given.limit(0), model, "t").count() == 0
    nothing = language.identified(given, language.train(docs.limit(0)), "t").first()
    assert nothing.lang is None


def test_rare_languages_and_clashing_columns(spark):
    """70 languages, one of them in two of 30,000 rows; rows without an id are told apart by their text."""
    def text(k, n):
        return " ".join(chr(0x4E00 + 40 * k + (n + j) % 30) * 3 for j in range(12))

    rows = [(None if n % 2 else n, text(n % 69, n), f"l{n % 69:02}") for n in range(30_000)] + [(None, text(69, 1), "l69"), (5, text(69, 2), "l69")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, sample=50)
    assert model.languages == [f"l{k:02}" for k in range(70)]
    asked = spark.createDataFrame([(k, text(k, 3), *["x"] * 6) for k in range(70)], "doc_id long, text string, score string, post string, total string, top string, lang string, given string")
    given = asked.withColumns({c: F.lit("") for c in ("declared", "host", "domain", "suffix")})
    found = language.identified(given, model, "t").collect()
    assert [r.lang for r in sorted(found, key=lambda r: r.doc_id)] == model.languages
    assert {(r.score, r.post, r.total, r.top, r.given) for r in found} == {("x",) * 5}


def test_pages_are_taken_apart(spark):
    html = '<!DOCTYPE html><HTML class="x" lang=\'fr-CA\'><style>p{a:b}</style><script>var t="</p>";</script><!-- <p>no --><p>Bon <b>jour</b>'
    rows = [(1, "https://user@WWW.Ab.Example.fr:80/en/x?q", html), (2, None, None), (3, "no address", "plain")]
    got = {r.page_id: r for r in language.page_rows(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[1].declared, got[1].host, got[1].domain, got[1].suffix, got[1].text.split()) == ("fr", "www.ab.example.fr", "example.fr", "fr", ["Bon", "jour"])
    assert (got[2].declared, got[2].host, got[2].text, got[3].text) == ("", "", "", "plain")


def test_toxicity_of_held_out_documents(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    half = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    model = toxicity.train(docs, half)
    assert np.all(np.diff(model.thresholds) > 0)
    rest = labels.join(half.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.col("toxic").alias("y"))
    found = toxicity.severities(docs, model).join(rest, "doc_id").select("severity", "toxic", "y").toPandas()
    bad = found[found.y == 1]
    assert bad.toxic.mean() > 0.75 and found[found.y == 0].toxic.mean() < 0.03
    assert bad.severity.mean() > 2.5 * found[found.y == 0].severity.mean()


def test_toxicity_of_odd_rows(spark):
    pairs = [(k, "you stupid idiot of the thing" if k % 3 == 0 else "the thing of the day") for k in range(120)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in pairs] + [(None, 1), (5, None), (3, 0), (999, 1)], "doc_id long, toxic int")
    numbered = [(k, f"{t} {k}") for k, t in pairs]
    model = toxicity.train(frame(spark, numbered), labels)
    odd = frame(spark, [(0, "stupid idiot, you!"), (1, ""), (2, None), (3, "word " * 50_000), (1, ""), (None, "stupid idiot of you")])
    got = toxicity.severities(odd.withColumn("grade", F.lit("clash")), model).collect()
    assert len(got) == 6 and "node" in got[0].asDict()
    assert {r.toxic for r in got if r.text and "idiot" in r.text} == {True}
    assert {r.toxic for r in got if not r.text or "word" in r.text} == {False}
    untaught = toxicity.train(frame(spark, numbered), labels.limit(0))
    assert not any(r.toxic for r in toxicity.severities(odd, untaught).collect())
    assert toxicity.severities(odd.limit(0), model).count() == 0


def test_gradient_raises_the_likelihood():
    rng = np.random.default_rng(0)
    grade = np.repeat([0, 1, 2, 3], 60)
    value, count, bounds = [], [], [0]
    for g in grade:
        value += [7, *rng.integers(100, 110, 3)] if g else list(rng.integers(100, 110, 4))
        count += [g or 1, 1, 1, 1]
        bounds.append(len(value))
    model = toxicity.fitted(np.array(value), np.array(count), np.array(bounds), grade)
    over = model.exceeding(np.array(value), np.array(count), np.array(bounds)).sum(axis=1)
    assert over[grade == 0].mean() < over[grade == 1].mean() < over[grade == 3].mean()


def test_the_model_is_fitted_in_little_memory():
    """The driver holds the sample's features once, however many; the work on them is done in blocks."""
    rng = np.random.default_rng(5)
    n, each = 400, 10_000
    toxic = np.arange(n) % 4 // 3
    value = rng.integers(0, 1000, n * each).astype(np.int32)
    value[::each] = np.where(toxic == 1, 7777, 5)
    count, bounds = np.ones(n * each, np.int32), np.arange(n + 1) * each
    tracemalloc.start()
    grade = toxicity.grades(value, count, bounds, toxic)
    model = toxicity.fitted(value, count, bounds, grade)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ((grade > 0) == (toxic == 1)).all()
    assert model.weights[7777] > 0
    assert peak < 2 * (value.nbytes + count.nbytes)
