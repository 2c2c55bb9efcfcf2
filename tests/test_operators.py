"""Operators on small inputs against brute force, in every physical variant."""

import datetime as dt
import random
from pathlib import Path

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from terrace.operators import dedup, history, joins, keys, quality, upsert
from terrace.plans.gold import sales_with_keys
from terrace.registry.inputs import raw

D = dt.date


def shuffled(df):
    return df.repartition(7).sortWithinPartitions(F.rand(3))


def skewed(n=2000, seed=5):
    """Half of all rows carry one key."""
    r = random.Random(seed)
    return [(0 if r.random() < 0.5 else r.randrange(40), r.randrange(10_000), i) for i in range(n)]


# -- one row per key ------------------------------------------------------
def test_keep_last_row_does_not_depend_on_placement(spark):
    df = spark.createDataFrame(skewed(), "k int, v int, source_row_number int")
    wanted = {}
    for k, v, n in skewed():
        wanted[k] = (k, v, n)
    for given in (df, shuffled(df), df.coalesce(1)):
        assert rows(dedup.keep_last_in_file(given, ["k"])) == sorted(wanted.values(), key=lambda r: tuple((True, str(x)) for x in r))


def test_ties_are_settled_by_all_columns(spark):
    data = [(1, "a", 2, None), (1, "b", 2, "x"), (1, "b", 2, "y"), (2, None, 1, "z")]
    df = spark.createDataFrame(data, "k int, a string, n int, b string")
    for given in (df, shuffled(df)):
        assert rows(dedup.keep_one(given, ["k"], [F.col("n").desc()])) == [(1, "b", 2, "y"), (2, None, 1, "z")]


def test_text_dates_compare_as_dates_and_unreadable_ones_lose(spark):
    data = [("a", "2024-01-02", 1), ("a", "9 May", 2), ("a", "", 3), ("b", "", 1), ("b", None, 2)]
    df = spark.createDataFrame(data, "k string, d string, n int")
    assert rows(dedup.keep_latest_date(df, ["k"], "d")) == [("a", "2024-01-02", 1), ("b", "", 1)]


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.keep_one(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


# -- keys -----------------------------------------------------------------
@pytest.mark.parametrize("slices", [None, 1, 3, 50])
def test_dense_key_equals_plain_numbering(spark, slices):
    data = sorted(skewed())
    df = shuffled(spark.createDataFrame(data, "k int, v int, n int"))
    got = keys.dense_key(df, ["k", "v", "n"], "key", first=5, slices=slices)
    assert sorted(tuple(r) for r in got.collect()) == [(i + 5, *row) for i, row in enumerate(data)]


def test_dense_key_of_nothing(spark):
    assert keys.dense_key(spark.createDataFrame([], "k int"), ["k"], "key").collect() == []


def test_dense_key_puts_nulls_first(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "k int")
    assert rows(keys.dense_key(df, ["k"], "key")) == [(1, None), (2, 1), (3, 2)]


def test_continued_ids(spark):
    old = spark.createDataFrame([("7",), ("x",), (" 9 ",), ("",)], "id string")
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    assert rows(keys.continue_numbers(old, "id", new, ["name"])) == [(10, "a"), (11, "b")]
    labels = spark.createDataFrame([("SO75117",), ("XX9",), ("SO",), ("SO75116",)], "id string")
    assert rows(keys.continue_prefixed(labels, "id", "SO", new, ["name"])) == [("SO75118", "a"), ("SO75119", "b")]
    longer = spark.createDataFrame([("SO99999",), ("SO100000",), ("SOX9",)], "id string")
    assert rows(keys.continue_prefixed(longer, "id", "SO", new, ["name"])) == [("SO100001", "a"), ("SO100002", "b")]
    with pytest.raises(ValueError):
        keys.continue_prefixed(labels, "id", "AW000", new, ["name"])


def test_the_last_file_beats_the_longer_one(spark):
    data = [("k", "old", "a.csv", at(1), 3), ("k", "new", "b.csv", at(2), 1), ("j", "same", "a.csv", at(1), 2), ("j", "later path", "b.csv", at(1), 1)]
    df = spark.createDataFrame(data, "k string, v string, source_file string, source_modified_at timestamp, source_row_number long")
    assert rows(dedup.keep_last_in_file(df, ["k"]), "k", "v") == [("j", "later path"), ("k", "new")]
    assert rows(dedup.keep_one(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])) == [(1,)]


def test_orphaned_rows_are_counted(spark):
    child = spark.createDataFrame([(7,), (7,), (7,), (1,), (None,)], "c int")
    rule = quality.related("c", spark.createDataFrame([(1,)], "k int"), "k")
    assert rows(quality.summarized("m", child, [rule]), "failed_row_count") == [(3,)]


def test_relations_of_a_fact_come_from_one_scan(spark):
    dims = [spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([("a",)], "name string")]
    data = [(1, "a"), (1, "b"), (3, "a"), (3, "a"), (None, "a"), (2, None), (None, None)]
    fact = spark.createDataFrame(data, "k int, s string")
    rule = quality.relations([("k", dims[0], "id"), ("s", dims[1], "name")], spark.createDataFrame([(0,)] * 6, "x int"))
    got = quality.summarized("m", fact, [rule])
    assert rows(got, "test_name", "test_status", "failed_row_count", "details") == [
        ("connected_k_s", "Warn", 6, ""), ("related_k", "Fail", 2, "k=3"), ("related_s", "Fail", 1, "s=b"),
        ("rows_as_delivered", "Fail", 1, "7 rows of 6 delivered"),
    ]
    clean = quality.summarized("m", fact.limit(0), [quality.relations([("k", dims[0], "id")])])
    assert rows(clean, "test_name", "test_status", "details") == [("connected_k", "Pass", None), ("related_k", "Pass", None)]
    found = joins.unconnected(fact, [("k", dims[0], "id"), ("s", dims[1], "name")])
    assert sorted(map(str, rows(found))) == sorted(map(str, data[1:]))


def test_details_show_the_smallest_violation(spark):
    df = spark.createDataFrame([(2, "x"), (1, None), (1, "y "), (1, "y ")], "k int, s string")
    found = quality.summarized("m", df, [quality.not_null("s"), quality.no_outer_blanks("s"), quality.unique_together("k", "s")], ["k"])
    assert rows(found, "test_name", "details") == [
        ("no_outer_blanks_s", "k=1"), ("not_null_s", "k=1"), ("unique_k_s", "k=1, s=y , duplicate_count=2")
    ]


# -- histories ------------------------------------------------------------
def test_next_in_key(spark):
    data = sorted(set((k, v) for k, v, _ in skewed()))
    wanted = []
    for i, (k, v) in enumerate(data):
        follows = i + 1 < len(data) and data[i + 1][0] == k
        wanted.append((k, v, data[i + 1][1] if follows else None))
    df = shuffled(spark.createDataFrame(data, "k int, v int"))
    got = history.next_in_key(df, ["k"], ["v"], "v", "n")
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[:2]) == wanted


def test_end_dates(spark):
    data = [
        ("p", 1, D(2011, 7, 1), D(2007, 12, 28)), ("p", 2, D(2012, 7, 1), D(2012, 9, 1)), ("p", 3, D(2013, 7, 1), None),
        ("q", 4, D(2011, 7, 1), D(2010, 1, 1)), ("r", 5, None, D(2010, 1, 1)),
    ]
    df = spark.createDataFrame(data, "k string, id int, s date, e date")
    repaired = history.with_end_dates(df, ["k"], "s", "e", ["id"], "repair")
    assert rows(repaired, "id", "e") == [
        (1, D(2012, 6, 30)), (2, D(2012, 9, 1)), (3, None), (4, None), (5, D(2010, 1, 1))
    ]
    derived = history.with_end_dates(df, ["k"], "s", "e", ["id"], "recompute")
    assert rows(derived, "id", "e") == [(1, D(2012, 6, 30)), (2, D(2013, 6, 30)), (3, None), (4, None), (5, None)]


VERSIONS = [
    ("p", 1, D(2011, 1, 1), D(2011, 12, 31)), ("p", 2, D(2012, 3, 1), D(2013, 2, 1)), ("p", 3, D(2014, 1, 1), None),
    ("q", 4, D(2010, 1, 1), D(2030, 1, 1)), ("q", 5, D(2012, 1, 1), None), ("r", 6, None, None),
    ("q", 7, D(2013, 1, 1), D(2012, 1, 1)), ("p", 8, D(2014, 1, 1), D(9999, 12, 31)),
]


def test_version_in_force(spark):
    days = [None, D(2010, 12, 31), D(2011, 1, 1), D(2011, 12, 31), D(2012, 1, 15), D(2012, 3, 1), D(2013, 2, 1),
            D(2014, 1, 1), D(2031, 1, 1), D(2999, 1, 1), D(1850, 1, 1)]
    facts = [(i, k, d) for i, (k, d) in enumerate((k, d) for k in ("p", "q", "r", "s", None) for d in days)]
    wanted = []
    for i, k, d in facts:
        found = [x for p, x, s, e in VERSIONS if p == k and d and s and s <= d and (e is None or d <= e)]
        wanted += [(i, x) for x in found or [None]]
    fact = spark.createDataFrame(facts, "i int, product string, day date")
    dim = spark.createDataFrame(VERSIONS, "number string, version int, s date, e date")
    got = history.join_version_in_force(fact, dim, "product", "number", "day", "s", "e")
    assert sorted((tuple(r) for r in got.select("i", "version").collect()), key=str) == sorted(wanted, key=str)


def test_many_versions_of_one_product(spark):
    """One product has most versions and rows."""
    starts = [D(2000, 1, 1) + dt.timedelta(days=3 * i) for i in range(900)]
    dims = [("hot", i, s, s + dt.timedelta(days=2)) for i, s in enumerate(starts)] + [("cold", 901, starts[0], None)]
    sales = [(str(i), "hot" if i % 3 else "cold", 1, D(2000, 1, 1) + dt.timedelta(days=i)) for i in range(2700)]
    dim = spark.createDataFrame(dims, "product_number string, product_key int, start_date date, end_date date")
    sold = spark.createDataFrame(sales, "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt date")
    sold = sold.withColumns({c: F.lit(None).cast("date") for c in ("sls_ship_dt", "sls_due_dt")})
    sold = sold.withColumns({c: F.lit(1) for c in ("sls_sales", "sls_quantity", "sls_price")})
    customers = spark.createDataFrame([(1, 100)], "customer_id int, customer_key int")
    got = rows(sales_with_keys(sold, dim, customers), "order_number", "product_key", "customer_key")
    wanted = [(str(i), i // 3 if i % 3 else 901, 100) for i in range(2700)]
    assert sorted(got) == sorted(wanted)


def test_close_versions(spark):
    df = spark.createDataFrame([("a", ""), ("a", "2020-01-01"), ("b", " "), ("c", None)], "k string, e string")
    listed = spark.createDataFrame([("a",), ("a",), ("c",), ("z",)], "k string")
    closed = history.close_versions(df, listed, "k", "e", F.lit("2024-03-01"))
    assert rows(closed) == [("a", "2020-01-01"), ("a", "2024-03-01"), ("b", " "), ("c", "2024-03-01")]


# -- upsert ---------------------------------------------------------------
def test_upsert_twice(spark):
    t0, t1, t2 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
    schema = "k int, v string, note string, created timestamp, updated timestamp"
    target = spark.createDataFrame([(1, "a", "n1", t0, t0), (2, "b", "n2", t0, t0)], schema)
    source = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")

    def apply(state, stamp):
        return upsert.upsert(
            state, source, ["k"], stamp=F.lit(stamp), created="created", updated="updated",
            action="action",
        )

    first = apply(target, t1)
    assert rows(first.drop("action")) == [
        (1, "a", "n1", t0, t0), (2, None, "n2", t0, t1), (3, "c", None, t1, t1)
    ]
    assert tuple(upsert.action_counts(first, "action").first()) == (1, 1, 1)
    second = apply(first.drop("action"), t2)
    assert tuple(upsert.action_counts(second, "action").first()) == (0, 2, 1)
    assert rows(second, "k", "created", "updated") == [(1, t0, t0), (2, t0, t2), (3, t1, t2)]
    assert [f.name for f in second.schema] == [*target.columns, "action"]


def test_upsert_with_two_keys(spark):
    target = spark.createDataFrame([("a", 1, 10), ("a", 2, 20)], "p string, q int, v int")
    source = spark.createDataFrame([("a", 2, 21), ("b", 1, 30)], "p string, q int, v int")
    assert rows(upsert.upsert(target, source, ["p", "q"])) == [("a", 1, 10), ("a", 2, 21), ("b", 1, 30)]


# -- joins ----------------------------------------------------------------
def test_null_keys_never_match(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, w string")
    assert rows(joins.enriched(left, right, {"k": "k"}, {"w": "w"})) == [(None, "b", None), (1, "a", "x")]
    assert rows(joins.without_match(left, right, {"k": "k"})) == [(None, "b")]
    assert rows(joins.unconnected(left, [("k", right, "k")])) == [(None, "b")]


# -- quality rules --------------------------------------------------------
CLEAN = [(1, "a", 2, 10, 5, D(2020, 1, 1), D(2020, 2, 1), "20200101")]
SCHEMA = "k int, s string, q int, sales int, price int, first date, last date, raw string"
RULES = {
    "not_null": (lambda p: quality.not_null("s"), [(2, None, 2, 10, 5, None, None, None)], 1),
    "unique": (lambda p: quality.unique("k"), CLEAN, 1),
    "together": (lambda p: quality.unique_together("k", "s"), CLEAN, 1),
    "primary_key_null": (lambda p: quality.primary_key("k"), [(None, "b", 2, 10, 5, None, None, None)], 1),
    "primary_key_twice": (lambda p: quality.primary_key("k"), CLEAN, 1),
    "natural_key": (lambda p: quality.unique_where_present("k", "s"), CLEAN, 1),
    "surrogate": (lambda p: quality.surrogate_key("k"), CLEAN, 1),
    "related": (lambda p: quality.related("k", p, "id"), [(9, "b", 2, 10, 5, None, None, None)] * 3, 1),
    "blanks": (lambda p: quality.no_outer_blanks("s"), [(2, "b ", 2, 10, 5, None, None, None)], 1),
    "negative": (lambda p: quality.not_negative("price"), [(2, "b", 2, 10, -1, None, None, None), (3, "c", 2, 10, None, None, None, None)], 2),
    "ends": (lambda p: quality.ends_after_start("first", "last"), [(2, "b", 2, 10, 5, D(2020, 1, 2), D(2020, 1, 1), None)], 1),
    "compact": (
        lambda p: quality.valid_compact_date("raw"),
        [(2, "b", 2, 10, 5, None, None, x) for x in ("0", "2010", "18991231", "20500102", "x", "-20200101", None)], 6,
    ),
    "order": (lambda p: quality.in_date_order("first", "last"), [(2, "b", 2, 10, 5, D(2020, 1, 2), D(2020, 1, 1), None)], 1),
    "measures": (
        lambda p: quality.consistent_measures("sales", "q", "price"),
        [(2, "b", 2, 11, 5, None, None, None), (3, "b", 2, 11, 5, None, None, None), (4, "b", None, 10, 5, None, None, None),
         (5, "b", 0, 0, 5, None, None, None)], 3,
    ),
    "range": (
        lambda p: quality.date_in_range("first", F.lit(D(2024, 1, 1))),
        [(2, "b", 2, 10, 5, D(1923, 12, 31), None, None), (3, "b", 2, 10, 5, D(2024, 1, 2), None, None)], 2,
    ),
    "accepted": (lambda p: quality.accepted_values("s", ["a"]), [(2, "b", 2, 10, 5, None, None, None), (2, None, 2, 10, 5, None, None, None)], 1),
    "converts": (lambda p: quality.converts("raw", lambda c: c.try_cast("int")), [(2, "b", 2, 10, 5, None, None, "x"), (2, "b", 2, 10, 5, None, None, " ")], 1),
    "connected": (lambda p: quality.connected([("k", p, "id")]), [(9, "b", 2, 10, 5, None, None, None), (None, "b", 2, 10, 5, None, None, None)], 2),
    "overlap": (lambda p: quality.no_overlap(["s"], "first", "last", ["k"]), [(2, "a", 2, 10, 5, D(2020, 1, 20), D(2021, 1, 1), None)], 1),
}


@pytest.mark.parametrize("name", sorted(RULES))
def test_rule_is_silent_on_clean_rows_and_fires_on_broken_ones(spark, name):
    make, broken, count = RULES[name]
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    rule = make(parent)
    clean = spark.createDataFrame(CLEAN, SCHEMA)
    dirty = clean.unionByName(spark.createDataFrame(broken, SCHEMA))
    assert rule.violations(clean).count() == 0
    assert rule.violations(dirty).count() == count
    status = [r.test_status for r in quality.summarized("m", clean, [rule]).collect()]
    assert status == [quality.PASS]
    line = quality.summarized("m", dirty, [rule]).first()
    failed = 3 if name == "related" else count  # three rows share the one orphaned value
    assert (line.failed_row_count, line.test_status) == (failed, rule.severity)


def test_unbounded_schema_takes_texts_of_any_length(spark):
    from pyspark.sql.types import StructType

    from terrace.operators.conform import conformed, unbounded, varchar

    declared = StructType([varchar("name", 3, False)])
    rows = spark.createDataFrame([("abcd",)], "name string")
    assert conformed(rows, unbounded(declared)).first().name == "abcd"
    assert not unbounded(declared)["name"].nullable
    with pytest.raises(Exception, match="longer than 3"):
        conformed(rows, declared).collect()


def test_where_repeated_chooses_among_repeated_keys_only(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("c", 5)], "k string, source_row_number int")
    seen = []

    def choose(some):
        seen.append(some.count())
        return dedup.keep_last_in_file(some, ["k"])

    wanted = [("a", 1), ("b", 2), ("c", 5)]
    assert rows(dedup.where_repeated(df, ["k"], choose)) == wanted
    monkeypatch.setattr(dedup, "FEW_REPEATED", 0)
    assert rows(dedup.where_repeated(df, ["k"], choose)) == wanted
    assert seen == [2, 4]
    assert rows(dedup.where_repeated(df.where("k != 'b'"), ["k"], choose)) == [("a", 1), ("c", 5)]


def test_line_items_are_dealt_once_for_sales(spark, folder):
    """By order: the grouping by order and part and the join to the orders take them as they lie."""
    items = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_tax double, l_shipdate timestamp"
    lines = [(1, 7, 1, 2.0, 0.05, D(2001, 1, 1)), (1, 7, 2, 3.0, 0.01, D(2001, 1, 2)), (2, 8, 6, 1.0, 0.0, D(2001, 1, 3)), (None, 8, 1, 1.0, 0.0, None)]
    lines = [(*r[:5], r[5] and dt.datetime(*r[5].timetuple()[:6])) for r in lines]
    spark.createDataFrame(lines, items).write.parquet(f"{folder}/lineitem.parquet")
    orders = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"
    held = [(1, 5, "O", "5-LOW", dt.datetime(2000, 12, 1)), (2, 6, "F", "5-LOW", dt.datetime(2000, 12, 2))]
    spark.createDataFrame(held, orders).write.parquet(f"{folder}/orders.parquet")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = raw(spark, folder, "crm_sales_details")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        assert rows(got, "sls_ord_num", "sls_prd_key", "sls_quantity", "sls_sales") == [(" SO1", "P7", " 3", ""), (" SO2", "P8", "0", "5")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_column_may_serve_the_order_only(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 0)], "k string, v int")
    numbered = keys.dense_key(df, ["k"], "key", unwritten=["k"])
    assert numbered.columns == ["key", "v"]
    assert rows(numbered) == [(1, 2), (2, 1), (3, 0)]
    assert "k" not in keys.in_slices(df, ["k"], unwritten=["k"]).columns


def test_a_lookup_is_not_broadcast_by_the_size_of_its_files(spark, folder):
    """Rows that take a few bytes each in a file take many times as much in memory."""
    spark.range(400_000).selectExpr("xxhash64(id) as k", "id % 3 as v").write.parquet(folder + "/lookup")
    lookup = spark.read.parquet(folder + "/lookup")
    files = sum(p.stat().st_size for p in Path(folder, "lookup").glob("*.parquet"))
    assert files < 10 << 20
    joined = joins.enriched(spark.range(1000), lookup, {"id": "k"}, {"v": "v"})
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().sparkPlan().toString()


def test_the_test_of_a_rule_is_made_once_for_a_row(spark):
    df = spark.createDataFrame([("x1",), ("y",), (None,), ("x0",)], "a string")
    rules = [quality.Rule("starts_with_x", lambda: F.col("a").rlike("^x[0-9]")), quality.not_null("a")]
    found = quality.summarized("m", df, rules)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1
    assert rows(found.select("test_name", "test_status", "failed_row_count", "details")) == [
        ("not_null_a", "Fail", 1, ""), ("starts_with_x", "Fail", 2, "a=x0")
    ]
