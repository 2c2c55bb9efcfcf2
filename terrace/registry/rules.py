"""Quality rules: the violating rows of each, and their summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.functions.convert import iso_date
from terrace.operators import quality as q
from terrace.plans.oplog import RunLog
from terrace.registry.inputs import AS_OF, WITH_DIRTY, as_of, dirty_lines, portable, sql_broken_measures, table
from terrace.registry.joining import _VERSIONS_SQL, versions
from terrace.session import fresh_path

_KEYS = ("l_orderkey", "l_linenumber", "l_partkey")
_K = ", ".join(_KEYS)


def _dirty_rows(rule, *columns):
    def query(spark, sf_dir):
        return portable(rule.violations(dirty_lines(spark, sf_dir)).select(*_KEYS, *columns))

    return query


def _dirty_groups(rule):
    return lambda spark, sf_dir: portable(rule.violations(dirty_lines(spark, sf_dir)))


def _shipping(spark, sf_dir):
    """Lines with order, ship and due day; some orders lie after shipping."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))
    lines = dirty_lines(spark, sf_dir).select(*_KEYS, "quantity", "ship_day")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    moved = F.when(F.col("quantity") > 45, F.date_add("order_day", 60)).otherwise(F.col("order_day"))
    return rows.select(*_KEYS, moved.alias("order_day"), "ship_day", F.date_add("order_day", 30).alias("due_day"))


_SHIPPING_SQL = f"""{WITH_DIRTY}, shipping AS (SELECT {_K}, ship_day,
  CASE WHEN quantity > 45 THEN o + 60 ELSE o END AS order_day, o + 30 AS due_day
FROM dirty JOIN (SELECT o_orderkey, cast(o_orderdate AS date) AS o FROM orders) x ON l_orderkey = o_orderkey)"""


def _date_order(spark, sf_dir):
    return portable(q.in_date_order("order_day", "ship_day", "due_day").violations(_shipping(spark, sf_dir)))


def _ends_after_start(spark, sf_dir):
    rule = q.ends_after_start("order_day", "ship_day")
    return portable(rule.violations(_shipping(spark, sf_dir)).select(*_KEYS, "order_day", "ship_day"))


def _related(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    rule = q.related("o_custkey", customers, "c_custkey")
    return rule.violations(table(spark, sf_dir, "orders"))


def _connected(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    parts = table(spark, sf_dir, "part").filter("p_size > 5")
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(*_KEYS, "o_custkey")
    rule = q.connected([("o_custkey", customers, "c_custkey"), ("l_partkey", parts, "p_partkey")])
    return rule.violations(lines)


def _births(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.add_months(F.to_date("o_orderdate"), F.when(F.col("o_orderstatus") == "F", -12 * 75).otherwise(12)).alias("born")
    )
    return portable(q.date_in_range("born", as_of()).violations(rows))


def _overlaps(spark, sf_dir):
    """Ends moved 200 days into the next version for parts of high numbers."""
    moved = F.when(F.month("start_day") == 1, F.date_add("end_day", F.when(F.year("start_day") == 1997, 200).otherwise(0)))
    rows = versions(spark, sf_dir).withColumn("end_day", moved)
    return portable(q.no_overlap(["part"], "start_day", "end_day").violations(rows))


def _line_rules(spark, sf_dir):
    parents = table(spark, sf_dir, "part").filter("p_size > 5")
    return [
        q.not_null("raw_code"),
        q.accepted_values("raw_code", ["A", "N", "R"]),
        q.no_outer_blanks("raw_number", "raw_money"),
        q.not_negative("price"),
        q.valid_compact_date("raw_compact"),
        q.converts("raw_day", iso_date),
        q.unique_together("l_orderkey", "l_linenumber"),
        q.related("l_partkey", parents, "p_partkey"),
        q.not_null("l_orderkey"),
    ]


def _summary(spark, sf_dir):
    return q.summarized("lines", dirty_lines(spark, sf_dir), _line_rules(spark, sf_dir), ["l_orderkey", "l_linenumber", "raw_code"])


def _summary_logged(spark, sf_dir):
    log = RunLog(spark, fresh_path(spark, "log"))
    log.record_checks(None, _summary(spark, sf_dir))
    return log.read("data_quality_results").select("model_name", "test_name", "test_status", "failed_row_count", "details")


def _star_relations(spark, sf_dir):
    """Lines with a customer or part that is unknown or missing, some of them twice; all rules from one scan of the keys."""
    customers = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    parts = table(spark, sf_dir, "part").filter("p_size > 5")
    lines = table(spark, sf_dir, "lineitem").select(
        *_KEYS, F.when(F.col("l_linenumber") != 4, F.col("l_suppkey")).alias("customer"), F.when(F.col("l_returnflag") != "A", F.col("l_partkey")).alias("part")
    )
    fact = lines.unionByName(lines.where("l_linenumber = 2"))
    rule = q.relations([("customer", customers, "c_custkey"), ("part", parts, "p_partkey")], lines)
    return q.summarized("fact", fact, [rule])


_STAR_SQL = """
WITH lines AS (SELECT l_linenumber, CASE WHEN l_linenumber <> 4 THEN l_suppkey END AS customer, CASE WHEN l_returnflag <> 'A' THEN l_partkey END AS part
  FROM lineitem), fact AS (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_linenumber = 2),
judged AS (SELECT *, coalesce(customer IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'), false) AS has_customer,
  coalesce(part IN (SELECT p_partkey FROM part WHERE p_size > 5), false) AS has_part FROM fact)
SELECT 'fact' AS model_name, test_name, CASE WHEN n = 0 THEN 'Pass' ELSE status END AS test_status, n AS failed_row_count, details FROM (
  SELECT 'related_customer' AS test_name, 'Fail' AS status, count(*) AS n, min('customer=' || customer) AS details
    FROM judged WHERE customer IS NOT NULL AND NOT has_customer UNION ALL
  SELECT 'related_part', 'Fail', count(*), min('part=' || part) FROM judged WHERE part IS NOT NULL AND NOT has_part UNION ALL
  SELECT 'connected_customer_part', 'Warn', count(*), min(concat_ws(', ', 'customer=' || customer, 'part=' || part))
    FROM judged WHERE NOT (has_customer AND has_part) UNION ALL
  SELECT 'rows_as_delivered', 'Fail', f - l, CASE WHEN f <> l THEN f || ' rows of ' || l || ' delivered' END
    FROM (SELECT (SELECT count(*) FROM fact) AS f, (SELECT count(*) FROM lines) AS l) x) t"""


_BAD_COMPACT = (
    "raw_compact IS NOT NULL AND (try_cast(trim(raw_compact) AS bigint) IS NULL OR try_cast(trim(raw_compact) AS bigint) <= 0"
    " OR length(cast(try_cast(trim(raw_compact) AS bigint) AS varchar)) <> 8"
    " OR try_cast(trim(raw_compact) AS bigint) > 20500101 OR try_cast(trim(raw_compact) AS bigint) < 19000101)"
)
_BAD_MEASURES = f"{sql_broken_measures('sales', 'quantity', 'price')}"
_NO_DAY = (
    "trim(raw_day) <> '' AND (CASE WHEN regexp_full_match(trim(raw_day), '[0-9]{4}-[0-9]{2}-[0-9]{2}')"
    " THEN try_strptime(trim(raw_day), '%Y-%m-%d') END) IS NULL"
)


def _counted(name: str, condition: str, status: str = "Fail") -> str:
    return (
        f"SELECT 'lines' AS model_name, '{name}' AS test_name, CASE WHEN count(*) = 0 THEN 'Pass' ELSE '{status}' END"
        f" AS test_status, count(*) AS failed_row_count, min(concat_ws(', ', 'l_orderkey=' || l_orderkey, 'l_linenumber=' || l_linenumber,"
        f" 'raw_code=' || raw_code)) AS details FROM dirty WHERE {condition}"
    )


_SUMMARY_SQL = WITH_DIRTY + " " + " UNION ALL ".join(
    [
        _counted("not_null_raw_code", "raw_code IS NULL"),
        _counted("accepted_raw_code", "raw_code NOT IN ('A', 'N', 'R')"),
        _counted("no_outer_blanks_raw_number_raw_money", "raw_number <> trim(raw_number) OR raw_money <> trim(raw_money)"),
        _counted("not_negative_price", "price IS NULL OR price < 0"),
        _counted("valid_date_raw_compact", _BAD_COMPACT),
        _counted("converts_raw_day", _NO_DAY, "Warn"),
        "SELECT 'lines', 'unique_l_orderkey_l_linenumber', CASE WHEN count(*) = 0 THEN 'Pass' ELSE 'Fail' END, count(*),"
        " min('l_orderkey=' || l_orderkey || ', l_linenumber=' || l_linenumber || ', duplicate_count=' || n) FROM"
        " (SELECT l_orderkey, l_linenumber, count(*) AS n FROM dirty GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d",
        "SELECT 'lines', 'related_l_partkey', CASE WHEN count(*) = 0 THEN 'Pass' ELSE 'Fail' END,"
        " coalesce(sum(n), 0)::bigint, min('l_partkey=' || l_partkey || ', row_count=' || n) FROM (SELECT l_partkey, count(*) AS n FROM dirty"
        " WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) GROUP BY 1) d",
        _counted("not_null_l_orderkey", "l_orderkey IS NULL"),
    ]
)

ENTRIES = {
    "rule_not_null": (
        _dirty_rows(q.not_null("raw_code"), "raw_number"),
        f"{WITH_DIRTY} SELECT {_K}, raw_number FROM dirty WHERE raw_code IS NULL",
    ),
    "rule_unique": (
        _dirty_groups(q.unique("raw_key")),
        f"{WITH_DIRTY} SELECT raw_key, count(*) AS duplicate_count FROM dirty WHERE raw_key IS NOT NULL GROUP BY 1"
        " HAVING count(*) > 1",
    ),
    "rule_unique_together": (
        _dirty_groups(q.unique_together("l_orderkey", "l_linenumber")),
        f"{WITH_DIRTY} SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM dirty GROUP BY 1, 2"
        " HAVING count(*) > 1",
    ),
    "rule_related": (
        _related,
        "SELECT o_custkey, count(*) AS row_count FROM orders WHERE o_custkey NOT IN"
        " (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1",
    ),
    "rule_primary_key": (
        _dirty_groups(q.primary_key("l_orderkey", "raw_code")),
        f"{WITH_DIRTY} SELECT l_orderkey, raw_code, count(*) AS duplicate_count FROM dirty GROUP BY 1, 2"
        " HAVING count(*) > 1 OR raw_code IS NULL OR l_orderkey IS NULL",
    ),
    "rule_no_outer_blanks": (
        _dirty_rows(q.no_outer_blanks("raw_number", "raw_money", "raw_code"), "raw_number", "raw_money", "raw_code"),
        f"{WITH_DIRTY} SELECT {_K}, raw_number, raw_money, raw_code FROM dirty WHERE raw_number <> trim(raw_number)"
        " OR raw_money <> trim(raw_money) OR raw_code <> trim(raw_code)",
    ),
    "rule_not_negative": (
        _dirty_rows(q.not_negative("price"), "price"),
        f"{WITH_DIRTY} SELECT {_K}, price FROM dirty WHERE price < 0 OR price IS NULL",
    ),
    "rule_ends_after_start": (
        _ends_after_start,
        f"{_SHIPPING_SQL} SELECT {_K}, cast(order_day AS varchar) AS order_day, cast(ship_day AS varchar) AS ship_day"
        " FROM shipping WHERE ship_day < order_day",
    ),
    "rule_valid_compact_date": (
        _dirty_rows(q.valid_compact_date("raw_compact"), "raw_compact"),
        f"{WITH_DIRTY} SELECT {_K}, raw_compact FROM dirty WHERE {_BAD_COMPACT}",
    ),
    "rule_date_order": (
        _date_order,
        f"{_SHIPPING_SQL} SELECT {_K}, cast(order_day AS varchar) AS order_day, cast(ship_day AS varchar) AS ship_day,"
        " cast(due_day AS varchar) AS due_day FROM shipping WHERE order_day > ship_day OR order_day > due_day",
    ),
    "rule_consistent_measures": (
        _dirty_groups(q.consistent_measures("sales", "quantity", "price")),
        f"{WITH_DIRTY} SELECT DISTINCT sales, quantity, price FROM dirty WHERE {_BAD_MEASURES} ORDER BY 1, 2, 3",
    ),
    "rule_date_in_range": (
        _births,
        "SELECT DISTINCT cast(born AS varchar) AS born FROM (SELECT cast(cast(o_orderdate AS date) + CASE WHEN"
        " o_orderstatus = 'F' THEN INTERVAL (-900) MONTH ELSE INTERVAL 12 MONTH END AS date) AS born FROM orders) b"
        f" WHERE born < DATE '1924-01-01' OR born > DATE '{AS_OF}'",
    ),
    "rule_accepted_values": (
        _dirty_rows(q.accepted_values("raw_code", ["A", "N", "R"]), "raw_code"),
        f"{WITH_DIRTY} SELECT {_K}, raw_code FROM dirty WHERE raw_code NOT IN ('A', 'N', 'R')",
    ),
    "rule_surrogate_key": (
        _dirty_groups(q.surrogate_key("l_partkey")),
        f"{WITH_DIRTY} SELECT l_partkey, count(*) AS duplicate_count FROM dirty GROUP BY 1 HAVING count(*) > 1",
    ),
    "rule_connected": (
        _connected,
        f"SELECT {_K}, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey NOT IN"
        " (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') OR l_partkey NOT IN"
        " (SELECT p_partkey FROM part WHERE p_size > 5)",
    ),
    "rule_natural_key": (
        _dirty_groups(q.unique_where_present("l_orderkey", "raw_code")),
        f"{WITH_DIRTY} SELECT l_orderkey, raw_code, count(*) AS duplicate_count FROM dirty"
        " WHERE raw_code IS NOT NULL AND l_orderkey IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "rule_no_overlap": (
        _overlaps,
        f"WITH {_VERSIONS_SQL}, moved AS (SELECT part, start_day, CASE WHEN year(start_day) = 1997 THEN end_day + 200"
        " ELSE end_day END AS end_day FROM versions), chained AS (SELECT *, lead(start_day) OVER"
        " (PARTITION BY part ORDER BY start_day) AS n FROM moved) SELECT part, cast(start_day AS varchar) AS start_day,"
        " cast(end_day AS varchar) AS end_day FROM chained WHERE n IS NOT NULL AND (end_day IS NULL OR end_day >= n)",
    ),
    "rules_summarized": (_summary, _SUMMARY_SQL),
    "fact_relations_at_once": (_star_relations, _STAR_SQL),
    "rules_logged": (_summary_logged, _SUMMARY_SQL),
}
