"""Upserts, replaced and versioned tables, schema operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType

from terrace.functions.convert import iso_date, to_money
from terrace.functions.text import clipped
from terrace.operators import upsert
from terrace.operators.conform import conformed, empty, field, varchar, with_defaults
from terrace.registry.inputs import WITH_DIRTY, dirty_lines, portable, table
from terrace.schemas import DATE, MONEY
from terrace.session import fresh_path
from terrace.sources.buckets import bucket_of, upsert_buckets
from terrace.sources.layers import Layers

_STAMP = "2002-03-01 00:00:00"
_EARLIER = "1999-01-01 00:00:00"
_AT = dt.datetime(2002, 3, 1, tzinfo=dt.timezone.utc)


def _target(spark, sf_dir):
    """Orders delivered until the end of 1998."""
    orders = table(spark, sf_dir, "orders").filter("o_orderdate < '1999-01-01'")
    at = F.lit(_EARLIER).cast("timestamp")
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", at.alias("created_at"), at.alias("updated_at"))


def _source(spark, sf_dir):
    """The next delivery: orders since 1997, repriced."""
    orders = table(spark, sf_dir, "orders").filter("o_orderdate >= '1997-01-01'")
    return orders.select("o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))


def _merged(spark, sf_dir):
    return upsert.upsert(
        _target(spark, sf_dir), _source(spark, sf_dir), ["o_orderkey"],
        stamp=F.lit(_STAMP).cast("timestamp"), created="created_at", updated="updated_at",
        action="action",
    )


_MERGED_SQL = f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= '1997-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderdate < '1999-01-01' THEN '{_EARLIER}' ELSE '{_STAMP}' END AS created_at,
  CASE WHEN o_orderdate >= '1997-01-01' THEN '{_STAMP}' ELSE '{_EARLIER}' END AS updated_at,
  CASE WHEN o_orderdate < '1997-01-01' THEN 'kept' WHEN o_orderdate < '1999-01-01' THEN 'updated' ELSE 'inserted' END AS action
FROM orders"""


def _merged_by_two(spark, sf_dir):
    """Customers keyed by number and nation; a delivery that leaves out the region of the lowest nations."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    earlier = F.lit(_EARLIER).cast("timestamp")
    target = customers.filter("c_nationkey < 15").withColumns({"created_at": earlier, "updated_at": earlier})
    source = customers.filter("c_nationkey >= 5").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return upsert.upsert(
        target, source, ["c_custkey", "c_nationkey"],
        stamp=F.lit(_STAMP).cast("timestamp"), created="created_at", updated="updated_at", action="action",
    )


_MERGED_BY_TWO_SQL = f"""
SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey >= 5 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_nationkey < 15 THEN '{_EARLIER}' ELSE '{_STAMP}' END AS created_at,
  CASE WHEN c_nationkey >= 5 THEN '{_STAMP}' ELSE '{_EARLIER}' END AS updated_at,
  CASE WHEN c_nationkey < 5 THEN 'kept' WHEN c_nationkey < 15 THEN 'updated' ELSE 'inserted' END AS action
FROM customer"""


def _counts(spark, sf_dir):
    return upsert.action_counts(_merged(spark, sf_dir), "action")


def _in_buckets(spark, sf_dir):
    """Customers in 32 buckets, then a delivery of one nation's rich ones and a new customer; who kept a folder kept it."""
    layers = _layers(spark)
    schema = StructType([field("c_custkey", LongType()), field("c_name", StringType()), field("c_acctbal", DoubleType())])
    layers.recreate({("bronze", "customer"): schema}, _AT)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    rich = customers.filter("c_nationkey = 7 AND c_acctbal > 9000")
    delivery = rich.select("c_custkey", (-F.col("c_acctbal")).alias("c_acctbal")).unionByName(
        spark.range(1).select(F.lit(-1).cast("bigint").alias("c_custkey"), F.lit(1.0).alias("c_acctbal"))
    )
    before: set[str] = set()
    results = []
    for rows in (customers.drop("c_nationkey"), delivery):
        found = upsert_buckets(layers, "bronze", "customer", rows, ["c_custkey"], 32)
        layers.publish({("bronze", "customer"): found.paths}, _AT)
        touched = rows.select(bucket_of(layers.read("bronze", "customer"), ["c_custkey"], 32)).distinct().count()
        as_due = len(found.rewritten) == touched and before - set(found.paths) <= before and len(before & set(found.paths)) == max(0, len(before) - touched)
        results.append((as_due, found.inserted, found.updated))
        before = set(found.paths)
    (_, _, _), (as_due, inserted, updated) = results
    return layers.read("bronze", "customer").select(
        "*", F.lit(as_due).alias("others_kept"), F.lit(inserted).cast("bigint").alias("inserted"), F.lit(updated).cast("bigint").alias("updated")
    )


_IN_BUCKETS_SQL = """
WITH rich AS (SELECT c_custkey FROM customer WHERE c_nationkey = 7 AND c_acctbal > 9000),
rows_after AS (SELECT c_custkey, c_name, CASE WHEN c_custkey IN (SELECT c_custkey FROM rich) THEN -c_acctbal ELSE c_acctbal END AS c_acctbal
  FROM customer UNION ALL SELECT -1, NULL, 1.0)
SELECT *, true AS others_kept, cast(1 AS bigint) AS inserted, (SELECT count(*) FROM rich) AS updated FROM rows_after"""


def _layers(spark):
    return Layers(spark, fresh_path(spark, "warehouse"))


def _replaced(spark, sf_dir):
    """A second full refresh leaves only its own rows."""
    layers = _layers(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    layers.replace("silver", "orders", orders, _AT)
    layers.replace("silver", "orders", orders.filter("o_totalprice > 250000"), _AT)
    return layers.read("silver", "orders")


def _published(spark, sf_dir):
    """Two tables switch together; a written but unpublished version is unseen."""
    layers = _layers(spark)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    paths = {("gold", "fact"): layers.write("gold", "fact", orders), ("gold", "dim"): layers.write("gold", "dim", customers)}
    layers.publish(paths, _AT)
    layers.write("gold", "fact", orders.filter("false"))
    return layers.read("gold", "fact").withColumn("part", F.lit("fact")).unionByName(
        layers.read("gold", "dim").withColumn("part", F.lit("dim"))
    )


def _created_once(spark, sf_dir):
    """Creating an existing table again keeps its rows; recreating empties it."""
    layers = _layers(spark)
    nations = table(spark, sf_dir, "nation")
    customers = table(spark, sf_dir, "customer")
    schemas = {("bronze", "nation"): nations.schema, ("bronze", "customer"): customers.schema}
    layers.create_if_absent(schemas, _AT)
    layers.replace("bronze", "nation", nations, _AT)
    layers.replace("bronze", "customer", customers, _AT)
    layers.create_if_absent(schemas, _AT)
    layers.recreate({("bronze", "nation"): nations.schema}, _AT)
    return (
        layers.read("bronze", "customer").select(F.col("c_name").alias("name"))
        .unionByName(layers.read("bronze", "nation").select(F.col("n_name").alias("name")))
    )


def _through_views(spark, sf_dir):
    """Tables of a layer read by name, a query kept as a view."""
    layers = _layers(spark)
    layers.replace("silver", "customer", table(spark, sf_dir, "customer"), _AT)
    layers.replace("silver", "nation", table(spark, sf_dir, "nation"), _AT)
    layers.expose("silver")
    by_country = spark.sql(
        "SELECT n_name, c_custkey FROM silver_customer JOIN silver_nation ON c_nationkey = n_nationkey"
    )
    layers.define_view("gold_customer_country", by_country)
    return spark.table("gold_customer_country")


def _through_databases(spark, sf_dir):
    """One database per layer; views registered once read what is published later, a stored query over them too."""
    layers = Layers(spark, fresh_path(spark, "warehouse"), prefix="terrace_")
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    layers.replace("silver", "customer", customers.filter("c_nationkey = 3"), _AT)
    layers.replace("gold", "nation", nations, _AT)
    for _ in range(2):
        layers.create_databases(("silver", "gold"))
        layers.register("silver")
        layers.register("gold")
    layers.define_view_in(
        "gold", "customer_country",
        "SELECT c_custkey, n_name FROM terrace_silver.customer JOIN terrace_gold.nation ON c_nationkey = n_nationkey",
    )
    before = spark.table("terrace_gold.customer_country").count()
    layers.replace("silver", "customer", customers, _AT)
    return spark.table("terrace_gold.customer_country").withColumn("before", F.lit(before).cast("bigint"))


_SCHEMA = StructType(
    [
        field("l_orderkey", IntegerType(), False), field("l_linenumber", IntegerType()),
        varchar("composite", 6), field("raw_money", MONEY), field("raw_day", DATE), field("absent", IntegerType()),
    ]
)


def _conformed(spark, sf_dir):
    money = F.when(F.col("raw_money").rlike("^ *[0-9.]+ *$"), F.col("raw_money"))
    day = F.when(F.length(F.trim("raw_day")) == 10, F.trim("raw_day"))
    # What does not fit is the model's to convert or to shorten; the table takes no other.
    rows = dirty_lines(spark, sf_dir).withColumns(
        {"raw_money": to_money(money), "raw_day": iso_date(day), "composite": clipped(F.col("composite"), 6)}
    )
    return portable(conformed(rows, _SCHEMA))


def _defaults(spark, sf_dir):
    stamped = with_defaults(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"),
        {"o_orderstatus": "unused", "meta_created_at": F.lit(_STAMP).cast("timestamp")},
    )
    return portable(stamped)


def _relaxed(spark, sf_dir):
    """Rows with a batch, then, when that may be missing, rows without; a column declared last is NULL in all files before."""
    layers = _layers(spark)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    strict = StructType([field("c_custkey", LongType(), False), field("c_name", StringType()), field("batch_id", IntegerType(), False)])
    layers.recreate({("bronze", "customer"): strict}, _AT)
    layers.insert("bronze", "customer", customers.where("c_nationkey < 5").withColumn("batch_id", F.lit(1)), _AT)
    layers.relax("bronze", "customer", ["batch_id"], _AT)
    layers.insert("bronze", "customer", customers.where("c_nationkey BETWEEN 5 AND 14"), _AT)
    layers.add_columns("bronze", "customer", [field("c_nationkey", LongType())], _AT)
    layers.insert("bronze", "customer", customers.where("c_nationkey > 14"), _AT)
    return Layers(spark, layers.root).read("bronze", "customer")


ENTRIES = {
    "upsert_large_source": (lambda s, d: portable(_merged(s, d)), _MERGED_SQL),
    "upsert_measured_source": (lambda s, d: portable(_merged_by_two(s, d)), _MERGED_BY_TWO_SQL),
    "upsert_in_buckets": (_in_buckets, _IN_BUCKETS_SQL),
    "upsert_counts": (
        _counts,
        "SELECT count(*) FILTER (WHERE o_orderdate >= '1999-01-01') AS rows_inserted,"
        " count(*) FILTER (WHERE o_orderdate >= '1997-01-01' AND o_orderdate < '1999-01-01') AS rows_updated,"
        " count(*) FILTER (WHERE o_orderdate < '1997-01-01') AS rows_kept FROM orders",
    ),
    "table_replaced": (_replaced, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000"),
    "tables_published_together": (
        _published,
        "SELECT o_orderkey AS id, 'fact' AS part FROM orders UNION ALL SELECT c_custkey, 'dim' FROM customer",
    ),
    "table_created_once": (_created_once, "SELECT c_name AS name FROM customer"),
    "tables_read_by_name": (
        _through_views,
        "SELECT n_name, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey",
    ),
    "layer_databases": (
        _through_databases,
        "SELECT c_custkey, n_name, (SELECT count(*) FROM customer WHERE c_nationkey = 3) AS before"
        " FROM customer JOIN nation ON c_nationkey = n_nationkey",
    ),
    "schema_conformed": (
        _conformed,
        f"{WITH_DIRTY} SELECT cast(l_orderkey AS integer) AS l_orderkey, l_linenumber, substr(composite, 1, 6) AS composite,"
        " cast(CASE WHEN regexp_full_match(trim(raw_money), '[0-9.]+') THEN try_cast(trim(raw_money) AS decimal(19,4)) END"
        " AS double) AS raw_money, cast(CASE WHEN length(trim(raw_day)) = 10 THEN"
        " cast(try_strptime(trim(raw_day), '%Y-%m-%d') AS date) END AS varchar) AS raw_day,"
        " cast(NULL AS integer) AS absent FROM dirty",
    ),
    "column_defaults": (
        _defaults,
        f"SELECT o_orderkey, o_orderstatus, '{_STAMP}' AS meta_created_at FROM orders",
    ),
    "metadata_made_optional": (
        _relaxed,
        "SELECT c_custkey, c_name, cast(CASE WHEN c_nationkey < 5 THEN 1 END AS integer) AS batch_id,"
        " cast(CASE WHEN c_nationkey > 14 THEN c_nationkey END AS bigint) AS c_nationkey FROM customer",
    ),
}
