"""Column expressions, each over every line item."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.functions import convert as v
from terrace.functions import measures as m
from terrace.functions import text as t
from terrace.operators.dedup import rejected_count, with_keys_present
from terrace.registry.inputs import (
    WITH_DIRTY,
    as_of,
    dirty_lines,
    portable,
    sql_age,
    sql_band,
    sql_lookup,
    sql_price,
    sql_sales,
    table,
)

_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_c = F.col

_SQL_INT = "CASE WHEN regexp_full_match(trim({0}), '[+-]?[0-9]+') THEN try_cast(trim({0}) AS integer) END"
_SQL_DAY = (
    "cast(CASE WHEN regexp_full_match(trim({0}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"
    " THEN cast(try_strptime(trim({0}), '%Y-%m-%d') AS date) END AS varchar)"
)
_SQL_COMPACT = (
    "cast(CASE WHEN regexp_full_match(trim({0}), '[0-9]{{8}}')"
    " THEN cast(try_strptime(trim({0}), '%Y%m%d') AS date) END AS varchar)"
)
_SQL_MONEY = (
    "cast(CASE WHEN regexp_full_match(trim({0}), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)')"
    " THEN try_cast(trim({0}) AS decimal(19,4)) END AS double)"
)


def _measures():
    return _c("sales"), _c("quantity"), _c("price")



# name -> (Spark expression, SQL expression); both over the dirty line items.
_EXPRESSIONS: dict[str, tuple[Callable[[], Column], str]] = {
    "trim_blanks": (lambda: t.trimmed(_c("raw_number")), "trim(raw_number)"),
    "trim_left_right": (lambda: t.trimmed_in_two_steps(_c("raw_number")), "ltrim(rtrim(raw_number))"),
    "upper_case": (lambda: F.upper(_c("raw_code")), "upper(raw_code)"),
    "blank_to_null": (lambda: t.blank_to_null(_c("raw_number")), "nullif(trim(raw_number), '')"),
    "default_for_null": (lambda: F.coalesce(_c("raw_code"), F.lit("n/a")), "coalesce(raw_code, 'n/a')"),
    "substring_and_left": (
        lambda: F.concat(F.substring(_c("composite"), 1, 5), F.lit("|"), F.substring(_c("composite"), 99, 5)),
        "substr(composite, 1, 5) || '|' || substr(composite, 99, 5)",
    ),
    "replace_text": (lambda: t.without(_c("raw_key"), "-"), "replace(raw_key, '-', '')"),
    "length_of_number": (lambda: t.text_length(_c("l_partkey")), "cast(length(cast(l_partkey AS varchar)) AS integer)"),
    "concat_null_as_empty": (
        lambda: t.joined(_c("raw_code"), _c("raw_number")),
        "coalesce(raw_code, '') || ' ' || coalesce(raw_number, '')",
    ),
    "text_to_integer": (lambda: v.to_int(_c("raw_number")), _SQL_INT.format("raw_number")),
    "text_to_iso_date": (lambda: v.iso_date(_c("raw_day")), _SQL_DAY.format("raw_day")),
    "text_to_compact_date": (lambda: v.compact_date(_c("raw_compact")), _SQL_COMPACT.format("raw_compact")),
    "text_to_money": (lambda: v.to_money(_c("raw_money")), _SQL_MONEY.format("raw_money")),
    "blank_money_is_zero": (
        lambda: v.money_or_zero(_c("raw_money")),
        _SQL_MONEY.format("coalesce(nullif(trim(raw_money), ''), '0')"),
    ),
    "clip_to_length": (lambda: t.clipped(_c("composite"), 9), "substr(composite, 1, 9)"),
    "text_to_flag": (
        lambda: v.to_flag(_c("raw_code"), "A", "R"),
        "CASE trim(raw_code) WHEN 'A' THEN true WHEN 'R' THEN false END",
    ),
    "open_end_flag": (lambda: v.flag_of(_c("quantity") > 10), "coalesce(quantity > 10, false)"),
    "instant_to_day": (lambda: v.day_of(_c("ship_day").cast("timestamp")), "cast(ship_day AS varchar)"),
    "day_before": (lambda: v.day_before(_c("ship_day")), "cast(cast(ship_day - INTERVAL 1 DAY AS date) AS varchar)"),
    "absolute_value": (lambda: F.abs(_c("sales")), "abs(sales)"),
    "whole_division": (
        lambda: m.whole_quotient(_c("sales"), _c("quantity")),
        "cast(sales // nullif(quantity, 0) AS integer)",
    ),
    "completed_age": (lambda: m.completed_age(_c("ship_day"), as_of()), sql_age("ship_day")),
    "age_band": (
        lambda: m.banded(_c("quantity")),
        sql_band("quantity"),
    ),
    "row_digest": (
        lambda: F.lower(F.hex(t.row_digest([_c("raw_code"), _c("raw_number"), _c("l_partkey")]))),
        "sha256(trim(coalesce(raw_code, '')) || chr(31) || trim(coalesce(raw_number, ''))"
        " || chr(31) || cast(l_partkey AS varchar))",
    ),
    "differs_from_own_trim": (lambda: t.has_outer_blanks(_c("raw_code")), "raw_code <> trim(raw_code)"),
    "decode_with_default": (
        lambda: t.decoded(_c("raw_code"), {"A": "Accepted", "R": "Returned"}, "UnKnown"),
        sql_lookup("upper(trim(raw_code))", (("A", "Accepted"), ("R", "Returned")), "'UnKnown'"),
    ),
    "decode_many_codes": (
        lambda: t.decoded(_c("raw_number"), {str(i): f"no. {i}" for i in range(1, 41)}, _c("raw_number")),
        "CASE WHEN try_cast(trim(raw_number) AS integer) BETWEEN 1 AND 40 AND"
        " regexp_full_match(trim(raw_number), '[0-9]+') THEN 'no. ' || trim(raw_number) ELSE raw_number END",
    ),
    "unknown_is_not_unequal": (
        lambda: F.when(_c("raw_code") != "A", "other").when(_c("quantity") <= 0, "none").otherwise("unknown or A"),
        "CASE WHEN raw_code <> 'A' THEN 'other' WHEN quantity <= 0 THEN 'none' ELSE 'unknown or A' END",
    ),
    "constant_and_flag": (
        lambda: F.when(_c("price").isNull(), F.lit(1)).otherwise(F.lit(0)),
        "CASE WHEN price IS NULL THEN 1 ELSE 0 END",
    ),
    "first_known_value": (
        # Flag N stands for a primary source that says it does not know.
        lambda: t.first_known(F.when(_c("raw_code") == "N", "unKnown").otherwise(_c("raw_code")), _c("raw_number"), "UnKnown"),
        "CASE WHEN raw_code <> 'N' THEN raw_code ELSE coalesce(raw_number, 'n/a') END",
    ),
    "category_of_composite": (lambda: t.category_of(_c("composite")), "replace(substr(composite, 1, 5), '-', '_')"),
    "number_of_composite": (lambda: t.number_of(_c("composite")), "substr(composite, 7)"),
    "keys_conformed": (
        lambda: t.without(t.without_prefix(_c("raw_key"), "NAS"), "-"),
        "replace(regexp_replace(raw_key, '^NAS', ''), '-', '')",
    ),
    "sales_repaired": (
        lambda: m.repaired_sales(*_measures()),
        sql_sales("sales", "quantity", "price"),
    ),
    "price_repaired": (
        lambda: m.repaired_price(*_measures()),
        sql_price("sales", "quantity", "price"),
    ),
    "future_dates_removed": (
        lambda: m.unless_after(_c("ship_day"), F.lit("1999-06-30").cast("date")),
        "cast(CASE WHEN ship_day > DATE '1999-06-30' THEN NULL ELSE ship_day END AS varchar)",
    ),
    "blind_to_case_and_trail": (
        lambda: t.folded(_c("raw_code")) == t.folded(F.lit("a")),
        "lower(rtrim(raw_code)) = 'a'",
    ),
}


def _expression_entry(make: Callable[[], Column], sql: str):
    def query(spark, sf_dir):
        return portable(dirty_lines(spark, sf_dir).select(*_KEYS, make().alias("result")))

    return query, f"{WITH_DIRTY} SELECT {', '.join(_KEYS)}, {sql} AS result FROM dirty"


# name -> (Spark row test, SQL row test); the surviving line items.
_FILTERS: dict[str, tuple[Callable[[], Column], str]] = {
    "keep_convertible": (
        lambda: v.to_int(_c("raw_number")).isNotNull(),
        f"({_SQL_INT.format('raw_number')}) IS NOT NULL",
    ),
    "keep_listed_values": (lambda: _c("raw_code").isin("A", "R"), "raw_code IN ('A', 'R')"),
    "keep_between": (lambda: _c("quantity").between(20, 29), "quantity BETWEEN 20 AND 29"),
    "keep_prefixed": (lambda: _c("raw_key").startswith("NAS"), "raw_key LIKE 'NAS%'"),
}


def _filter_entry(make: Callable[[], Column], sql: str):
    def query(spark, sf_dir):
        return dirty_lines(spark, sf_dir).filter(make()).select(*_KEYS, "raw_number", "raw_code", "raw_key")

    return query, f"{WITH_DIRTY} SELECT {', '.join(_KEYS)}, raw_number, raw_code, raw_key FROM dirty WHERE {sql}"


def _keys_not_null(spark, sf_dir):
    rows = with_keys_present(dirty_lines(spark, sf_dir), ["raw_number"], blank_is_missing=False)
    return rows.select(*_KEYS, "raw_number")


def _keys_not_blank(spark, sf_dir):
    rows = with_keys_present(dirty_lines(spark, sf_dir), ["raw_number", "raw_code"])
    return rows.select(*_KEYS, "raw_number", "raw_code")


def _rejected(spark, sf_dir):
    return rejected_count(dirty_lines(spark, sf_dir), ["raw_number", "raw_code"])


def _renamed(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_number"),
        F.col("c_mktsegment").alias("segment"),
    )


def _durations(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    end = F.col("ts").cast("timestamp")
    start = F.date_trunc("hour", end) + F.expr("interval 999 milliseconds")
    return events.select(
        "event_id",
        v.elapsed_seconds(start, end).cast("double").alias("elapsed"),
        v.seconds_crossed(start, end).alias("crossed"),
    )


ENTRIES = {
    **{name: _expression_entry(*pair) for name, pair in _EXPRESSIONS.items()},
    **{name: _filter_entry(*pair) for name, pair in _FILTERS.items()},
    "keep_keys_not_null": (
        _keys_not_null,
        f"{WITH_DIRTY} SELECT {', '.join(_KEYS)}, raw_number FROM dirty WHERE raw_number IS NOT NULL",
    ),
    "keep_keys_not_blank": (
        _keys_not_blank,
        f"{WITH_DIRTY} SELECT {', '.join(_KEYS)}, raw_number, raw_code FROM dirty"
        " WHERE trim(raw_number) <> '' AND trim(raw_code) <> ''",
    ),
    "rejected_rows_counted": (
        _rejected,
        f"{WITH_DIRTY} SELECT count(*) FILTER (WHERE coalesce(trim(raw_number), '') = ''"
        " OR coalesce(trim(raw_code), '') = '') AS rows_rejected, count(*) AS rows_read FROM dirty",
    ),
    "business_names": (
        _renamed,
        "SELECT c_custkey AS customer_id, c_name AS customer_number, c_mktsegment AS segment FROM customer",
    ),
    "load_durations": (
        _durations,
        "SELECT event_id, cast(epoch_us(ts) // 1000 - epoch_us(s) // 1000 AS double) / 1000 AS elapsed,"
        " date_diff('second', s, ts) AS crossed"
        " FROM (SELECT *, date_trunc('hour', ts) + INTERVAL 999 MILLISECOND AS s FROM events) e",
    ),
}
