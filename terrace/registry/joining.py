"""Enrichment, version and absence joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.operators import history, joins, upsert
from terrace.registry.inputs import portable, table
from terrace.session import written

# Product versions: a start in every year a part was shipped, end the day
# before the next start, the last one open. Long histories: a start in every month a supplier shipped.
_YEARLY, _MONTHLY = ("l_partkey", "year"), ("l_suppkey", "month")
_VERSIONS_SQL = """
starts AS (SELECT DISTINCT l_partkey AS part, cast(date_trunc('year', l_shipdate) AS date) AS start_day FROM lineitem),
versions AS (SELECT part, start_day,
  cast(lead(start_day) OVER (PARTITION BY part ORDER BY start_day) - INTERVAL 1 DAY AS date) AS end_day FROM starts)"""


def _long(sql: str) -> str:
    """The same SQL over the long histories."""
    return sql.replace("l_partkey", "l_suppkey").replace("date_trunc('year'", "date_trunc('month'")


def _starts(spark, sf_dir, kind=_YEARLY):
    key, unit = kind
    day = F.to_date(F.date_trunc(unit, "l_shipdate")).alias("start_day")
    starts = table(spark, sf_dir, "lineitem").select(F.col(key).alias("part"), day).distinct()
    return written(starts, "starts")  # read twice by the slices


def versions(spark, sf_dir, kind=_YEARLY):
    open_ended = _starts(spark, sf_dir, kind).withColumn("end_day", F.lit(None).cast("date"))
    return history.with_end_dates(
        open_ended, ["part"], "start_day", "end_day", mode="recompute"
    )


def _lines(spark, sf_dir, key="l_partkey"):
    """Line items; without a ship day in one line of each order."""
    day = F.when(F.col("l_linenumber") != 7, F.to_date("l_shipdate")).alias("day")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", key, day)


_LINES_SQL = """
lines AS (SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber <> 7 THEN cast(l_shipdate AS date) END AS day FROM lineitem)"""


def _with_category(spark, sf_dir):
    """Parts of one type are missing from the lookup."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    lookup = table(spark, sf_dir, "part").filter("p_type <> 'PROMO'")
    return joins.enriched(lines, lookup, {"l_partkey": "p_partkey"}, {"p_type": "category", "p_brand": "subcategory"})


def _folded_lookup(spark, sf_dir):
    """Segments written in lower case with trailing blanks still match."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lower("c_mktsegment"), F.lit(" ")).alias("segment")
    )
    totals = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    totals = totals.filter("c_mktsegment <> 'BUILDING'")
    return joins.enriched(customers, totals, {"segment": "c_mktsegment"}, {"n": "n"}, fold=True)


def _two_lookups(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer")
    rows = joins.enriched(orders, customers, {"o_custkey": "c_custkey"}, {"c_name": "name", "c_nationkey": "nation"})
    other = customers.filter("c_mktsegment <> 'BUILDING'")
    rows = joins.enriched(rows, other, {"o_custkey": "c_custkey"}, {"c_mktsegment": "segment"})
    regions = table(spark, sf_dir, "nation").filter("n_regionkey < 4")
    return joins.enriched(rows, regions, {"nation": "n_nationkey"}, {"n_name": "country"})


def _in_force(kind=_YEARLY):
    key = kind[0]

    def query(spark, sf_dir):
        known = versions(spark, sf_dir, kind).filter(F.year("start_day") >= 1997)
        rows = history.join_version_in_force(
            _lines(spark, sf_dir, key), known, key, "part", "day", "start_day", "end_day"
        )
        return portable(rows.select("l_orderkey", "l_linenumber", key, "day", "start_day", "end_day"))

    return query


_IN_FORCE_SQL = f"""WITH {_VERSIONS_SQL}, {_LINES_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, cast(day AS varchar) AS day,
  cast(start_day AS varchar) AS start_day, cast(end_day AS varchar) AS end_day
FROM lines LEFT JOIN (SELECT * FROM versions WHERE year(start_day) >= 1997) v
  ON l_partkey = part AND day >= start_day AND (day <= end_day OR end_day IS NULL)"""


def _overlapping(spark, sf_dir):
    """Every version of a part stays open, so later lines meet several."""
    open_ended = _starts(spark, sf_dir).withColumn("end_day", F.lit(None).cast("date"))
    rows = history.join_version_in_force(
        _lines(spark, sf_dir), open_ended, "l_partkey", "part", "day", "start_day", "end_day"
    )
    return portable(rows.select("l_orderkey", "l_linenumber", "l_partkey", "start_day"))


def _current(spark, sf_dir):
    current = history.current_only(versions(spark, sf_dir), "end_day").filter(F.year("start_day") >= 2001)
    rows = history.join_current(_lines(spark, sf_dir), current, "l_partkey", "part")
    return portable(rows.select("l_orderkey", "l_linenumber", "l_partkey", "start_day"))


def _surrogates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    dim = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'")
    dim = dim.select("c_custkey", (F.col("c_custkey") + 1000).alias("customer_key"))
    return joins.enriched(orders, dim, {"o_custkey": "c_custkey"}, {"customer_key": "customer_key"})


def _to_update(spark, sf_dir):
    target = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return upsert.rows_to_update(target, table(spark, sf_dir, "orders"), ["o_orderkey"]).select("o_orderkey", "o_totalprice")


def _to_insert(spark, sf_dir):
    target = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return upsert.rows_to_insert(target, table(spark, sf_dir, "orders"), ["o_orderkey"]).select("o_orderkey", "o_totalprice")


def _no_match_two_keys(spark, sf_dir):
    """Lines without another line of the same order and part carrying flag R."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    flagged = lines.filter("l_returnflag = 'R'")
    return joins.without_match(lines, flagged, {"l_orderkey": "l_orderkey", "l_partkey": "l_partkey"})


def _unconnected(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'A'")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.unconnected(
        orders, [("o_custkey", customers, "c_custkey"), ("o_orderkey", lines, "l_orderkey")]
    )


def _histories(mode, kind=_YEARLY):
    """End dates before the start, on it and missing, by year of the version."""

    def query(spark, sf_dir):
        years = F.year("start_day")
        end = (
            F.when(years < 1998, F.date_sub("start_day", 100))
            .when(years < 2000, F.date_add("start_day", 100))
        )
        rows = _starts(spark, sf_dir, kind).withColumn("end_day", end)
        return portable(history.with_end_dates(rows, ["part"], "start_day", "end_day", mode=mode))

    return query


def _histories_sql(expression):
    return f"""WITH {_VERSIONS_SQL.split('versions AS')[0].rstrip().rstrip(',')},
given AS (SELECT part, start_day, cast(CASE WHEN year(start_day) < 1998 THEN start_day - INTERVAL 100 DAY
  WHEN year(start_day) < 2000 THEN start_day + INTERVAL 100 DAY END AS date) AS end_day FROM starts),
chained AS (SELECT *, cast(lead(start_day) OVER (PARTITION BY part ORDER BY start_day) - INTERVAL 1 DAY AS date) AS d FROM given)
SELECT part, cast(start_day AS varchar) AS start_day, cast({expression} AS varchar) AS end_day FROM chained"""


def _next_start(kind=_YEARLY):
    def query(spark, sf_dir):
        rows = history.next_in_key(
            _starts(spark, sf_dir, kind), ["part"], ["start_day"], "start_day", "next_start"
        )
        return portable(rows)

    return query


_NEXT_SQL = f"""WITH {_VERSIONS_SQL.split('versions AS')[0].rstrip().rstrip(',')}
SELECT part, cast(start_day AS varchar) AS start_day,
  cast(lead(start_day) OVER (PARTITION BY part ORDER BY start_day) AS varchar) AS next_start FROM starts"""


def _next_line(spark, sf_dir):
    """One flag holds a third of all lines and is spread over tasks."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_orderkey").agg(
        F.max("l_quantity").alias("quantity")
    )
    lines = written(lines, "lines")  # read twice by the slices
    return history.next_in_key(lines, ["l_returnflag"], ["l_orderkey"], "quantity", "next_quantity")


def _closed(spark, sf_dir):
    """Discontinue the parts that were once shipped with flag R and quantity 50."""
    listed = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' AND l_quantity = 50")
    keys = listed.select(F.col("l_partkey").alias("part"))
    on = F.lit("2002-03-01").cast("date")
    return portable(history.close_versions(versions(spark, sf_dir), keys, "part", "end_day", on))


_VERSION_COLUMNS = "part, cast(start_day AS varchar) AS start_day, cast({} AS varchar) AS end_day"

ENTRIES = {
    "join_category": (
        _with_category,
        "SELECT l_orderkey, l_linenumber, l_partkey, p_type AS category, p_brand AS subcategory FROM lineitem"
        " LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') p ON l_partkey = p_partkey",
    ),
    "join_two_lookups": (
        _two_lookups,
        "SELECT o_orderkey, o_custkey, c.c_name AS name, c.c_nationkey AS nation, d.c_mktsegment AS segment,"
        " n_name AS country FROM orders LEFT JOIN customer c ON o_custkey = c.c_custkey"
        " LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') d ON o_custkey = d.c_custkey"
        " LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 4) n ON c.c_nationkey = n_nationkey",
    ),
    "join_blind_to_case": (
        _folded_lookup,
        "SELECT c_custkey, lower(c_mktsegment) || ' ' AS segment, n FROM customer LEFT JOIN"
        " (SELECT c_mktsegment AS s, count(*) AS n FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1) t"
        " ON lower(c_mktsegment) = lower(s)",
    ),
    "join_version_in_force": (_in_force(), _IN_FORCE_SQL),
    "join_version_in_force_by_year": (_in_force(_MONTHLY), _long(_IN_FORCE_SQL)),
    "join_overlapping_versions": (
        _overlapping,
        f"WITH {_VERSIONS_SQL}, {_LINES_SQL} SELECT l_orderkey, l_linenumber, l_partkey,"
        " cast(start_day AS varchar) AS start_day FROM lines LEFT JOIN starts ON l_partkey = part AND day >= start_day",
    ),
    "join_current_version": (
        _current,
        f"WITH {_VERSIONS_SQL}, {_LINES_SQL} SELECT l_orderkey, l_linenumber, l_partkey,"
        " cast(start_day AS varchar) AS start_day FROM lines LEFT JOIN"
        " (SELECT * FROM versions WHERE end_day IS NULL AND year(start_day) >= 2001) v ON l_partkey = part",
    ),
    "current_versions": (
        lambda spark, sf_dir: portable(history.current_only(versions(spark, sf_dir), "end_day")),
        f"WITH {_VERSIONS_SQL} SELECT {_VERSION_COLUMNS.format('end_day')} FROM versions WHERE end_day IS NULL",
    ),
    "surrogate_lookup": (
        _surrogates,
        "SELECT o_orderkey, o_custkey, c_custkey + 1000 AS customer_key FROM orders"
        " LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') c ON o_custkey = c_custkey",
    ),
    "rows_to_update": (
        _to_update,
        "SELECT o_orderkey, o_totalprice FROM orders WHERE EXISTS"
        " (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')",
    ),
    "rows_to_insert": (
        _to_insert,
        "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT EXISTS"
        " (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')",
    ),
    "absent_by_two_keys": (
        _no_match_two_keys,
        "SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag FROM lineitem a WHERE NOT EXISTS"
        " (SELECT 1 FROM lineitem b WHERE a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey"
        " AND b.l_returnflag = 'R')",
    ),
    "facts_without_dimension": (
        _unconnected,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
        " LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON o_custkey = c_custkey"
        " LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A') l ON o_orderkey = l_orderkey"
        " WHERE c_custkey IS NULL OR l_orderkey IS NULL",
    ),
    "next_start_of_key": (_next_start(), _NEXT_SQL),
    "next_start_of_key_in_slices": (_next_start(_MONTHLY), _long(_NEXT_SQL)),
    "next_row_of_hot_key": (
        _next_line,
        "SELECT l_returnflag, l_orderkey, quantity, lead(quantity) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey)"
        " AS next_quantity FROM (SELECT l_returnflag, l_orderkey, max(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2) q",
    ),
    "end_dates_repaired": (
        _histories("repair"),
        _histories_sql("CASE WHEN end_day < start_day THEN d ELSE end_day END"),
    ),
    "end_dates_recomputed": (_histories("recompute"), _histories_sql("d")),
    "end_dates_repaired_in_slices": (
        _histories("repair", _MONTHLY),
        _long(_histories_sql("CASE WHEN end_day < start_day THEN d ELSE end_day END")),
    ),
    "versions_discontinued": (
        _closed,
        f"WITH {_VERSIONS_SQL} SELECT "
        + _VERSION_COLUMNS.format(
            "CASE WHEN end_day IS NULL AND part IN (SELECT l_partkey FROM lineitem"
            " WHERE l_returnflag = 'R' AND l_quantity = 50) THEN DATE '2002-03-01' ELSE end_day END"
        )
        + " FROM versions",
    ),
}
