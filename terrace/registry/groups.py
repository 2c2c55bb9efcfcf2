"""Duplicates, distinct values, one row per key, surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.operators import dedup, keys, quality
from terrace.registry.inputs import GIVEN, WITH_DIRTY, dirty_lines, sql_broken_measures, table

_LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,"
    " l_returnflag, l_linestatus"
)
# The tie-break of keep_one: every other column, in table order, largest first.
_LINE_TIE = (
    "l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST,"
    " l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,"
    " l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST, l_shipdate DESC NULLS LAST"
)


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def _picked(df):
    return df.select(*[c.strip() for c in _LINE_COLUMNS.split(",")])


def _kept(order_sql: str) -> str:
    return (
        f"SELECT {_LINE_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber"
        f" ORDER BY {order_sql}) AS rn FROM lineitem) r WHERE rn = 1"
    )


_LINE_KEY = ["l_orderkey", "l_linenumber"]


def _last_row(spark, sf_dir):
    """The extended price serves as row number in the file."""
    return _picked(dedup.keep_last_in_file(_lines(spark, sf_dir), _LINE_KEY, "l_extendedprice"))


def _latest_date(spark, sf_dir):
    return _picked(dedup.keep_latest_date(_lines(spark, sf_dir), _LINE_KEY, "l_shipdate"))


def _latest_text_date(spark, sf_dir):
    rows = dirty_lines(spark, sf_dir).select("l_partkey", "raw_day", "l_orderkey", "l_linenumber", "l_suppkey")
    return dedup.keep_latest_date(rows, ["l_partkey"], "raw_day")


def _one_per_hot_key(spark, sf_dir):
    """Three keys, each holding a third of all rows."""
    rows = _lines(spark, sf_dir).select("l_returnflag", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey")
    return dedup.keep_one(rows, ["l_returnflag"], [F.col("l_extendedprice").desc_nulls_last()])


def _any_row(spark, sf_dir):
    return _picked(dedup.keep_one(_lines(spark, sf_dir), _LINE_KEY))


def _table_counts(spark, sf_dir):
    return quality.row_counts({("data", name): table(spark, sf_dir, name) for name in GIVEN})


def _continued(spark, sf_dir):
    """Ids go on after the highest number among those of orders and all dirty texts."""
    existing = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    dirty = existing.unionByName(dirty_lines(spark, sf_dir).select(F.col("raw_number").alias("id")))
    fresh = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return keys.continue_numbers(dirty, "id", fresh, ["c_custkey"])


def _continued_text(spark, sf_dir):
    existing = table(spark, sf_dir, "customer").select(F.col("c_name").alias("label"))
    fresh = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return keys.continue_prefixed(existing, "label", "Customer#", fresh, ["o_orderkey"])


def _line_keys(spark, sf_dir):
    lines = _lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax", "l_discount"
    )
    return keys.dense_key(lines, lines.columns, "sales_key")


def _order_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return keys.dense_key(orders, ["o_orderpriority", "o_orderkey"], "order_key", slices=16)


def _customer_keys(spark, sf_dir):
    """Identity in a declared insertion order, starting again at 1."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return keys.dense_key(customers, ["c_custkey"], "customer_key")


def _appended(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    return keys.append_rows(customers, suppliers, customers)


ENTRIES = {
    "duplicate_keys": (
        lambda spark, sf_dir: quality.duplicates(_lines(spark, sf_dir), ["l_orderkey"]),
        "SELECT l_orderkey, count(*) AS duplicate_count FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    ),
    "duplicate_or_null_keys": (
        lambda spark, sf_dir: quality.null_or_duplicate(dirty_lines(spark, sf_dir), ["raw_code"]),
        f"{WITH_DIRTY} SELECT raw_code, count(*) AS duplicate_count FROM dirty GROUP BY 1"
        " HAVING count(*) > 1 OR raw_code IS NULL",
    ),
    "duplicate_combinations": (
        lambda spark, sf_dir: quality.duplicates(_lines(spark, sf_dir), ["l_orderkey", "l_partkey"]),
        "SELECT l_orderkey, l_partkey, count(*) AS duplicate_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "table_row_counts": (
        _table_counts,
        " UNION ALL ".join(
            f"SELECT 'data' AS schema_name, '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in GIVEN
        ),
    ),
    "distinct_values": (
        lambda spark, sf_dir: quality.domain(dirty_lines(spark, sf_dir), "raw_code"),
        f"{WITH_DIRTY} SELECT DISTINCT raw_code FROM dirty",
    ),
    "distinct_triples_filtered": (
        lambda spark, sf_dir: quality.domain(
            dirty_lines(spark, sf_dir).filter(quality.broken_measures("sales", "quantity", "price")),
            "sales", "quantity", "price",
        ),
        f"{WITH_DIRTY} SELECT DISTINCT sales, quantity, price FROM dirty"
        f" WHERE {sql_broken_measures('sales', 'quantity', 'price')}",
    ),
    "ordered_values": (
        lambda spark, sf_dir: quality.domain(dirty_lines(spark, sf_dir), "sales", "quantity", "price").orderBy(
            "sales", "quantity", "price"
        ),
        f"{WITH_DIRTY} SELECT DISTINCT sales, quantity, price FROM dirty ORDER BY 1, 2, 3",
    ),
    "highest_number_in_text": (
        lambda spark, sf_dir: keys.highest_number(dirty_lines(spark, sf_dir), "raw_number"),
        f"{WITH_DIRTY} SELECT max(CASE WHEN regexp_full_match(trim(raw_number), '[+-]?[0-9]+')"
        " THEN try_cast(trim(raw_number) AS bigint) END) AS highest FROM dirty",
    ),
    "highest_prefixed_text": (
        lambda spark, sf_dir: keys.highest_prefixed(table(spark, sf_dir, "customer"), "c_name", "Customer#0"),
        "SELECT max(c_name) AS highest FROM customer WHERE starts_with(c_name, 'Customer#0') AND length(c_name) > 10",
    ),
    "keep_last_row": (_last_row, _kept(f"l_extendedprice DESC NULLS LAST, {_LINE_TIE}")),
    "keep_latest_date": (_latest_date, _kept(f"l_shipdate DESC NULLS LAST, {_LINE_TIE}")),
    "keep_latest_text_date": (
        _latest_text_date,
        f"{WITH_DIRTY} SELECT l_partkey, raw_day, l_orderkey, l_linenumber, l_suppkey FROM (SELECT *, row_number() OVER"
        " (PARTITION BY l_partkey ORDER BY CASE WHEN regexp_full_match(trim(raw_day), '[0-9]{4}-[0-9]{2}-[0-9]{2}')"
        " THEN cast(try_strptime(trim(raw_day), '%Y-%m-%d') AS date) END DESC NULLS LAST, raw_day DESC NULLS LAST,"
        " l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS rn FROM dirty) r WHERE rn = 1",
    ),
    "keep_any_row": (_any_row, _kept(_LINE_TIE)),
    "keep_one_of_hot_key": (
        _one_per_hot_key,
        "SELECT l_returnflag, l_extendedprice, l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER"
        " (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC)"
        " AS rn FROM lineitem) r WHERE rn = 1",
    ),
    "dense_key_of_lines": (
        _line_keys,
        "SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,"
        " l_tax, l_discount) AS sales_key, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,"
        " l_tax, l_discount FROM lineitem",
    ),
    "dense_key_of_orders": (
        _order_keys,
        "SELECT row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS order_key, o_orderkey, o_custkey,"
        " o_orderpriority FROM orders",
    ),
    "identity_key_of_customers": (
        _customer_keys,
        "SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey, c_name, c_nationkey FROM customer",
    ),
    "continued_numbers": (
        _continued,
        f"{WITH_DIRTY} SELECT (SELECT max(n) FROM (SELECT o_orderkey AS n FROM orders UNION ALL"
        " SELECT try_cast(trim(raw_number) AS bigint) FROM dirty WHERE regexp_full_match(trim(raw_number), '[0-9]+')) i)"
        " + row_number() OVER (ORDER BY c_custkey) AS id, c_custkey, c_name FROM customer",
    ),
    "continued_prefixed_text": (
        _continued_text,
        "SELECT 'Customer#' || cast((SELECT max(cast(substr(c_name, 10) AS bigint)) FROM customer)"
        " + row_number() OVER (ORDER BY o_orderkey) AS varchar) AS label, o_orderkey, o_custkey FROM orders",
    ),
    "appended_rows": (
        _appended,
        "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier"
        " UNION ALL SELECT c_name, c_nationkey FROM customer",
    ),
}

