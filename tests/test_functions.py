"""Column expressions on hand-written values."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from terrace.functions import convert as v
from terrace.functions import measures as m
from terrace.functions import text as t

D = dt.date


def results(spark, schema, values, make):
    """One result per value, in order; tuples fill several columns."""
    given = [(i, *(x if isinstance(x, tuple) else (x,))) for i, x in enumerate(values)]
    df = spark.createDataFrame(given, f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(make().alias("r")).collect()]


CASES = {
    "trim_keeps_tabs": ("s string", [" a ", "\ta ", None], lambda: t.trimmed(F.col("s")), ["a", "\ta", None]),
    "blank_to_null": ("s string", ["  ", "", " x", None], lambda: t.blank_to_null(F.col("s")), [None, None, "x", None]),
    "present": ("s string", ["  ", "", " x", None], lambda: t.is_present(F.col("s")), [False, False, True, False]),
    "clip": ("s string", ["abcdef", "ab", None], lambda: t.clipped(F.col("s"), 3), ["abc", "ab", None]),
    "joined": (
        "a string, b string", [(None, "Smith"), ("Al", None), (None, None), ("Al", "Bo")],
        lambda: t.joined(F.col("a"), F.col("b")), [" Smith", "Al ", " ", "Al Bo"],
    ),
    "decode": (
        "s string", [" s", "M ", "x", "", None],
        lambda: t.decoded(F.col("s"), {"S": "Single", "M": "Married"}, "UnKnown"),
        ["Single", "Married", "UnKnown", "UnKnown", "UnKnown"],
    ),
    "decode_case_kept": (
        "s string", ["US", "us", " DE "],
        lambda: t.decoded(F.col("s"), {"US": "United States", "DE": "Denmark"}, t.trimmed(F.col("s")), fold_case=False),
        ["United States", "us", "Denmark"],
    ),
    "decode_long_list": (
        "s string", ["7", " 40", "41", None],
        lambda: t.decoded(F.col("s"), {str(i): f"n{i}" for i in range(41)}, "?"), ["n7", "n40", "?", "?"],
    ),
    "prefix": ("s string", ["NASAW1", "AW1", "NAS", None], lambda: t.without_prefix(F.col("s"), "NAS"), ["AW1", "AW1", "", None]),
    "composite": (
        "s string", ["AC-HE-HL-U509-R", "CO-RF", None],
        lambda: F.concat(t.category_of(F.col("s")), F.lit("|"), t.number_of(F.col("s"))),
        ["AC_HE|HL-U509-R", "CO_RF|", None],
    ),
    "first_known": (
        "a string, b string", [("Male", "F"), ("UnKnown", "F"), ("unknown ", None), (None, "F"), ("UnKnown", "")],
        lambda: t.first_known(F.col("a"), F.col("b"), "UnKnown"), ["Male", "F", "n/a", "F", ""],
    ),
    "outer_blanks": ("s string", ["a", "a ", " a", None], lambda: t.has_outer_blanks(F.col("s")), [False, True, True, None]),
    "folded": ("s string", ["A ", "a", " a", None], lambda: t.folded(F.col("s")) == t.folded(F.lit("a")), [True, True, False, None]),
    "int": (
        "s string", [" 11 ", "12.5", "", "abc", "99999999999", "-3", None],
        lambda: v.to_int(F.col("s")), [11, None, None, None, None, -3, None],
    ),
    "int_or_zero": ("s string", ["", "  ", "x", "4"], lambda: v.int_or_zero(F.col("s")), [0, 0, None, 4]),
    "money": (
        "s string", ["12.34565", "1e3", "$5", " 7 ", "-.5", "", None, "."],
        lambda: v.to_money(F.col("s")),
        [Decimal("12.3457"), None, None, Decimal("7.0000"), Decimal("-0.5000"), None, None, None],
    ),
    "money_or_zero": ("s string", ["", None, "x"], lambda: v.money_or_zero(F.col("s")), [Decimal("0.0000")] * 2 + [None]),
    "iso": (
        "s string", ["2024-02-29", "2024-02-30", "2024", "2024-2-3", " 2024-01-05 ", "2024-01-05x", "", None],
        lambda: v.iso_date(F.col("s")), [D(2024, 2, 29), None, None, None, D(2024, 1, 5), None, None, None],
    ),
    "compact": (
        "s string", ["20240103", "0", "2010", "", "20240230", "202401031", None],
        lambda: v.compact_date(F.col("s")), [D(2024, 1, 3), None, None, None, None, None, None],
    ),
    "compact_number": ("n int", [20240103, 0, 2010, None], lambda: v.compact_date(F.col("n")), [D(2024, 1, 3), None, None, None]),
    "flag": ("s string", ["Yes", " No ", "maybe", "yes", None], lambda: v.to_flag(F.col("s")), [True, False, None, None, None]),
    "day_before": ("d date", [D(2024, 3, 1), None], lambda: v.day_before(F.col("d")), [D(2024, 2, 29), None]),
    "age": (
        "b date, d date",
        [(D(2000, 2, 29), D(2023, 2, 27)), (D(2000, 2, 29), D(2023, 2, 28)), (D(1990, 5, 5), D(2024, 5, 5)),
         (D(1990, 5, 6), D(2024, 5, 5)), (None, D(2024, 1, 1))],
        lambda: m.completed_age(F.col("b"), F.col("d")), [22, 23, 34, 33, None],
    ),
    "band": (
        "n int", [19, 20, 29, 30, 49, 50, None],
        lambda: m.banded(F.col("n")), ["Under 20", "20-29", "20-29", "30-39", "40-49", "50+", "Unknown"],
    ),
    "future": ("d date", [D(2024, 1, 2), D(2024, 1, 1), None], lambda: m.unless_after(F.col("d"), F.lit(D(2024, 1, 1))), [None, D(2024, 1, 1), None]),
    "quotient": ("a int, b int", [(7, 2), (7, 0), (None, 2), (-7, 2)], lambda: m.whole_quotient(F.col("a"), F.col("b")), [3, None, None, -3]),
}
AMOUNTS = [(10, 3, -4), (10, 0, None), (None, 2, 5), (10, 2, 5), (-1, 2, 5), (9, 2, 5), (10, None, 5), (0, 0, 0)]
CASES["sales_repaired"] = (
    "s int, q int, p int", AMOUNTS,
    lambda: m.repaired_sales(F.col("s"), F.col("q"), F.col("p")), [12, 10, 10, 10, 10, 10, 10, 0],
)
CASES["price_repaired"] = (
    "s int, q int, p int", AMOUNTS,
    lambda: m.repaired_price(F.col("s"), F.col("q"), F.col("p")), [3, None, 5, 5, 5, 5, 5, None],
)


@pytest.mark.parametrize("name", sorted(CASES))
def test_expression(spark, name):
    schema, values, make, wanted = CASES[name]
    assert results(spark, schema, values, make) == wanted


def test_row_digest_matches_hashlib(spark):
    values = [(" a\t", None), ("\xa0b ", "c d"), ("", "  "), ("\x1cé", "ü　")]
    got = results(spark, "a string, b string", values, lambda: t.row_digest([F.col("a"), F.col("b")]))
    wanted = [hashlib.sha256("\x1f".join((x or "").strip() for x in pair).encode()).digest() for pair in values]
    assert [bytes(g) for g in got] == wanted and len(got[0]) == 32


def test_durations(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 2, 100000)
    assert results(spark, "a timestamp, b timestamp", [(a, b)], lambda: v.elapsed_seconds(F.col("a"), F.col("b"))) == [Decimal("1.2000")]
    assert results(spark, "a timestamp, b timestamp", [(a, b)], lambda: v.seconds_crossed(F.col("a"), F.col("b"))) == [2]
