"""CSV scans and exports, lineage, and the bronze load with its log.

Spark first writes the shared tables as CSV into the shared folder.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from terrace.operators.conform import empty
from terrace.plans import bronze
from terrace.plans.bronze import load_source
from terrace.plans.oplog import RunLog
from terrace.plans.presets import CURRENT
from terrace.plans.warehouse import Warehouse
from terrace.registry.inputs import raw, table, with_raw
from terrace.schemas import SOURCE_BY_NAME, Source, raw_schema
from terrace.session import fresh_path, written
from terrace.sources import files
from terrace.sources.layers import Layers

_AT = dt.datetime(2002, 3, 1, tzinfo=dt.timezone.utc)
_BATCH = "00000000-0000-0000-0000-000000000001"


def _exported(df, label):
    path = fresh_path(df.sparkSession, label)
    files.export_csv(df, path)
    return path


def _customer_file(spark, sf_dir):
    """Customers in which some names are empty."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("c_name"), "c_mktsegment"
    )
    return _exported(rows, "customers")


def _by_name(spark, sf_dir):
    scan = files.scan_by_name(
        spark, _customer_file(spark, sf_dir), ["c_mktsegment", "c_name", "c_phone", "c_custkey"], keep_blank=True
    )
    return scan.select("c_mktsegment", "c_name", "c_phone", "c_custkey")


def _by_position(spark, sf_dir):
    names = ["number", "label", "segment"]
    schema = StructType([StructField(n, StringType()) for n in names])
    return files.scan_by_position(spark, _customer_file(spark, sf_dir), schema).select(*names)


def _typed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    schema = StructType(
        [StructField("o_orderkey", LongType()), StructField("o_orderpriority", StringType()),
         StructField("o_totalprice", DoubleType())]
    )
    return files.scan_typed(spark, _exported(orders, "orders"), schema)


def _typed_tolerant(spark, sf_dir):
    """A column declared as a number holds one only for some segments."""
    schema = StructType([StructField("c_custkey", IntegerType()), StructField("number", IntegerType()), StructField("c_mktsegment", StringType())])
    number = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey").cast("string")).otherwise(F.col("c_name"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", number.alias("number"), "c_mktsegment")
    found = files.scan_typed(spark, _exported(rows, "customers"), schema, tolerate=True)
    return found.select("c_custkey", "number", "c_mktsegment", F.col(files.MALFORMED).isNotNull().alias("malformed"))


# Lines of birth facts: some short, some long, some with a date nobody can read, some with quotes and commas.
MESSY = """
SELECT id, c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') AS bad, CASE c_mktsegment
  WHEN 'BUILDING' THEN id || ',' || born
  WHEN 'MACHINERY' THEN id || ',' || born || ',M,more'
  WHEN 'HOUSEHOLD' THEN id || ',soon,' || c_name
  WHEN 'FURNITURE' THEN id || ',' || born || ',"' || c_name || ', ""the"" one"'
  ELSE id || ',' || born || ',' || c_name END AS line,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN c_name || ', "the" one' ELSE c_name END AS name, born
FROM (SELECT *, 'AW' || cast(c_custkey AS {text}) AS id, '1990-05-' || cast(c_nationkey + 5 AS {text}) AS born
  FROM {customer} WHERE c_nationkey BETWEEN 5 AND 25) c"""
_BIRTHS = SOURCE_BY_NAME["erp_cust_az12"]


def _messy_file(spark, sf_dir):
    """Four files of such lines, each below its header."""
    table(spark, sf_dir, "customer").createOrReplaceTempView("messy_customers")
    lines = spark.sql(MESSY.format(text="string", customer="messy_customers"))
    lines = lines.select("line", F.pmod(F.hash("id"), F.lit(4)).alias("part"), F.lit(1).alias("place"))
    headers = spark.range(4).select(F.lit("CID,BDATE,GEN").alias("line"), F.col("id").cast("int").alias("part"), F.lit(0).alias("place"))
    path = fresh_path(spark, "messy")
    lines.unionByName(headers).repartition(4, "part").sortWithinPartitions("part", "place").select("line", "part").write.partitionBy("part").text(path)
    return path


def _quarantined(spark, sf_dir):
    """Good lines loaded typed, all others kept as delivered, both from one pass, and the counts of the load."""
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"), preset=CURRENT, malformed="quarantine")
    counts = warehouse.load_bronze({_BIRTHS.name: _messy_file(spark, sf_dir)}, [_BIRTHS])[_BIRTHS.name]
    good = warehouse.layers.read("bronze", _BIRTHS.name).select(
        F.lit("good").alias("verdict"), F.lit(None).cast("string").alias("line"), "CID", F.col("BDATE").cast("string").alias("BDATE"), "GEN"
    )
    nothing = [F.lit(None).cast("string").alias(c) for c in _BIRTHS.columns]
    bad = bronze.quarantined(warehouse.layers, _BIRTHS).select("verdict", "line", *nothing)
    told = {"lines_read": counts.read, "lines_loaded": counts.inserted, "lines_malformed": counts.malformed}
    return good.unionByName(bad).select("*", *[F.lit(n).cast("bigint").alias(c) for c, n in told.items()])


def _quarantined_sql():
    return (
        f"WITH messy AS ({MESSY.format(text='varchar', customer='customer')}) SELECT CASE WHEN bad THEN 'malformed' ELSE 'good' END AS verdict,"
        " CASE WHEN bad THEN line END AS line, CASE WHEN NOT bad THEN id END AS \"CID\", CASE WHEN NOT bad THEN born END AS \"BDATE\","
        " CASE WHEN NOT bad THEN name END AS \"GEN\", (SELECT count(*) FROM messy) AS lines_read,"
        " (SELECT count(*) FROM messy WHERE NOT bad) AS lines_loaded, (SELECT count(*) FROM messy WHERE bad) AS lines_malformed FROM messy"
    )


def _quoted(spark, sf_dir):
    """Fields with delimiters, doubled quotes and line breaks, exported and loaded by the warehouse."""
    source = SOURCE_BY_NAME["erp_loc_a101"]
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(', "x"')).alias("CID"),
        F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('", end\n')).alias("CNTRY"),
    )
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"), multiline=True, malformed="quarantine")
    warehouse.set_up()
    counts = warehouse.load_bronze({source.name: _exported(rows, "quoted")}, [source])[source.name]
    found = warehouse.layers.read("bronze", source.name).select("CID", "CNTRY")
    return found.withColumn("malformed", F.lit(counts.malformed).cast("bigint"))


def _lineage(spark, sf_dir):
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    scan = files.scan_by_name(spark, _customer_file(spark, sf_dir), columns)
    rows = files.with_lineage(scan, columns, _BATCH, _AT)
    return rows.select(
        "c_custkey", "batch_id", F.col("loaded_at").cast("string").alias("loaded_at"),
        F.lower(F.hex("row_hash")).alias("row_hash"), F.col("source_file").endswith(".csv").alias("has_file"),
    )


def _row_numbers(spark, sf_dir):
    """Lines sorted in several files. Numbers must follow the order: the weighted sum falls with any other numbering.

    The weight grows with the third power of the rows. It is summed exactly; of one that no long holds, as
    from some millions of rows on, the column has the low 64 bits.
    """
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select(*keys)
    path = _exported(lines.repartitionByRange(5, "l_orderkey").sortWithinPartitions(*keys), "lines")
    staged = written(files.scan_by_name(spark, path, keys), "staged")
    numbered = files.with_row_numbers(staged)
    # A file's numbers start anew; with the rows of files before it they count through the table.
    sizes = numbered.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("l_orderkey").cast("bigint")).alias("first"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b.first") < F.col("a.first"), "left").groupBy(F.col("a.source_file").alias("source_file")).agg(
        F.coalesce(F.sum("b.n"), F.lit(0)).alias("before")
    )
    through = numbered.join(before, "source_file").withColumn("number", F.col("before") + F.col("source_row_number"))
    weight = F.sum(F.col("number").cast("decimal(19,0)") * F.col("l_orderkey").cast("decimal(19,0)")).alias("weight")
    found = through.agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("number").alias("numbers"), F.max("number").alias("highest"), weight
    )
    turn, half = F.lit(Decimal(1 << 64)), F.lit(Decimal(1 << 63))
    low = F.pmod(F.col("weight").cast("decimal(38,0)"), turn)
    return found.withColumn("weight", F.when(low >= half, low - turn).otherwise(low).cast("bigint"))


def _export_round_trip(spark, sf_dir):
    """Names with quotes and commas, exported and read back; lines end in CR LF."""
    name = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"'))
    path = _exported(table(spark, sf_dir, "part").select("p_partkey", name.alias("p_name"), "p_brand"), "parts")
    back = files.scan_typed(spark, path, StructType([StructField("p_partkey", LongType()), StructField("p_name", StringType()), StructField("p_brand", StringType())]))
    lines = spark.read.text(path, lineSep="\n").filter("value like 'p_partkey,p_name,p_brand%'")
    return back.withColumn("crlf", F.lit(lines.filter("value like '%\r'").count() == lines.count()))


def _file_facts(spark, sf_dir):
    name = F.element_at(F.split("source_file", "/"), -1)
    return files.file_facts(spark, f"{sf_dir}/*.parquet").select(
        name.alias("file"), "file_size_bytes", F.col("file_modified_at").isNotNull().alias("dated")
    )


def _written_file_facts(spark, sf_dir):
    """Sizes of files this query writes: one of names for each type and brand, a line each, and one without a byte."""
    root = fresh_path(spark, "names")
    names = table(spark, sf_dir, "part").select("p_type", "p_brand", "p_name")
    names.repartition("p_type", "p_brand").write.partitionBy("p_type", "p_brand").text(root)
    names.limit(0).select("p_name").coalesce(1).write.text(f"{root}/p_type=none/p_brand=none")
    folders = F.split("source_file", "/")
    held = [F.regexp_replace(F.url_decode(F.element_at(folders, -at)), "^[a-z_]+=", "").alias(c) for at, c in ((3, "p_type"), (2, "p_brand"))]
    # The folder names were escaped once by the writer and once in the path.
    again = [F.url_decode(c).alias(c) for c in ("p_type", "p_brand")]
    return files.file_facts(spark, root, recursive=True).select(*held, "file_size_bytes").select(*again, "file_size_bytes")


_CUSTOMERS = Source(
    "crm_cust_info",
    ("cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr", "cst_create_date"),
    ("cst_id",),
    "cst_create_date",
)


def _two_loads(spark, sf_dir):
    """All customers once, then again with every order: mostly updates."""
    layers = Layers(spark, fresh_path(spark, "warehouse"))
    log = RunLog(spark, layers.root)
    layers.recreate({("bronze", _CUSTOMERS.name): raw_schema(_CUSTOMERS)}, _AT)
    job = log.start_job("bronze_load")
    deliveries = {
        "first": raw(spark, sf_dir, "crm_cust_info").filter("cst_marital_status is not null"),
        "second": raw(spark, sf_dir, "cust_deliveries"),
    }
    for label, rows in deliveries.items():
        task = log.start_task(job, label)
        path = _exported(rows, label)
        loaded = load_source(layers, _CUSTOMERS, path, _BATCH, _AT, prefer="latest_date")
        counts = loaded.counts
        log.record_files(job, loaded.audit)
        log.finish_task(
            task, "Success", "loaded", rows_read=counts.read, rows_inserted=counts.inserted,
            rows_updated=counts.updated, rows_rejected=counts.rejected,
        )
    log.finish_job(job, "Success", "done")
    return layers, log


def _resumed(spark, sf_dir):
    """A run that broke at one of two tables, ended by another process; then a folder with one file loaded before and one new."""
    places, births = SOURCE_BY_NAME["erp_loc_a101"], SOURCE_BY_NAME["erp_cust_az12"]
    root, folder = fresh_path(spark, "warehouse"), fresh_path(spark, "delivered")
    rows = {s.name: raw(spark, sf_dir, s.name) for s in (places, births)}
    paths = {s: _exported(r, s) for s, r in rows.items()}
    first = Warehouse(spark, root)
    first.set_up()
    try:
        first.load_bronze({**paths, births.name: fresh_path(spark, "absent")}, [places, births])
        raise AssertionError("a missing file must fail the load")
    except AnalysisException:
        pass
    second = Warehouse(spark, root)
    job = second.log.unfinished("bronze_load")
    second.load_bronze(paths, [places, births], resume=job)
    tasks = second.log.task_runs().where(F.col("job_run_id") == job)
    part = F.when(F.col("CID").isNull(), F.lit(0)).otherwise(F.length("CID") % 2)
    delivered = rows[births.name].withColumn("part", part)
    for k in (0, 1):
        files.export_csv(delivered.where(f"part = {k}").drop("part").coalesce(1), f"{folder}/{k}")
        counts = second.load_bronze({births.name: f"{folder}/*"}, [births], only_new=True)[births.name]
    runs = tasks.groupBy("task_name", "task_status").agg(F.count(F.lit(1)).alias("tasks"), F.sum("rows_read").alias("rows_read"))
    ended = second.log.job_runs().where(F.col("job_run_id") == job).select(
        F.lit("the run").alias("task_name"), F.col("pl_status").alias("task_status"), F.lit(1).cast("bigint").alias("tasks"), F.lit(None).cast("bigint").alias("rows_read")
    )
    again = spark.range(1).select(
        F.lit("second folder").alias("task_name"), F.lit("Success").alias("task_status"), F.lit(1).cast("bigint").alias("tasks"),
        F.lit(counts.read).cast("bigint").alias("rows_read"),
    )
    return runs.unionByName(ended).unionByName(again)


_RESUMED_SQL = f"""{with_raw("erp_loc_a101", "erp_cust_az12")}
SELECT 'bronze.erp_loc_a101' AS task_name, 'Success' AS task_status, cast(1 AS bigint) AS tasks, (SELECT count(*) FROM raw_erp_loc_a101) AS rows_read
UNION ALL SELECT 'bronze.erp_cust_az12', 'Failed', 1, NULL UNION ALL SELECT 'bronze.erp_cust_az12', 'Success', 1, (SELECT count(*) FROM raw_erp_cust_az12)
UNION ALL SELECT 'the run', 'Success', 1, NULL
UNION ALL SELECT 'second folder', 'Success', 1, (SELECT count(*) FROM raw_erp_cust_az12 WHERE "CID" IS NOT NULL AND length("CID") % 2 = 1)"""


def _bronze_rows(spark, sf_dir):
    layers, _ = _two_loads(spark, sf_dir)
    return layers.read("bronze", _CUSTOMERS.name).select("cst_id", "cst_key", "cst_create_date")


def _load_counts(spark, sf_dir):
    _, log = _two_loads(spark, sf_dir)
    return log.task_runs().select(
        "task_name", "task_status", "rows_read", "rows_inserted", "rows_updated", "rows_rejected"
    )


def _job_log(spark, sf_dir):
    """One finished job, one alert, and the files of both loads."""
    _, log = _two_loads(spark, sf_dir)
    job = log.job_runs().first()
    log.alert(job.job_run_id, "Info", "loaded", "two deliveries")
    runs = log.job_runs().select(F.col("pipeline_name").alias("name"), F.col("pl_status").alias("state"))
    alerts = log.read("alerts").select(F.col("alert_subject").alias("name"), F.col("severity").alias("state"))
    audited = log.read("source_file_audit").groupBy("source_name").agg(F.sum("row_count").alias("n"))
    return runs.unionByName(alerts).withColumn("n", F.lit(None).cast("bigint")).unionByName(
        audited.select(F.col("source_name").alias("name"), F.lit("audited").alias("state"), "n")
    )


def _layer_counts(spark, sf_dir):
    """Row counts of published tables, recorded and read back."""
    layers = Layers(spark, fresh_path(spark, "warehouse"))
    log = RunLog(spark, layers.root)
    layers.replace("silver", "orders", table(spark, sf_dir, "orders"), _AT)
    layers.replace("gold", "lineitem", table(spark, sf_dir, "lineitem"), _AT)
    layers.replace("gold", "nothing", empty(spark, table(spark, sf_dir, "nation").schema), _AT)
    from terrace.operators.quality import row_counts

    log.record_counts(None, row_counts({key: layers.read(*key) for key in layers.tables()}))
    return log.read("table_row_counts").select("schema_name", "table_name", "row_count")


_FIRST = "(SELECT * FROM raw_crm_cust_info WHERE cst_marital_status IS NOT NULL)"
_HAS_ID = "trim(cst_id) <> ''"

ENTRIES = {
    "csv_by_header_name": (
        _by_name,
        "SELECT c_mktsegment, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name ELSE '' END AS c_name, '' AS c_phone,"
        " cast(c_custkey AS varchar) AS c_custkey FROM customer",
    ),
    "csv_by_position": (
        _by_position,
        "SELECT cast(c_custkey AS varchar) AS number, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS label,"
        " c_mktsegment AS segment FROM customer",
    ),
    "csv_typed": (_typed, "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders"),
    "csv_typed_tolerant": (
        _typed_tolerant,
        "SELECT cast(c_custkey AS integer) AS c_custkey, cast(CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey END AS integer)"
        " AS number, c_mktsegment, c_mktsegment <> 'BUILDING' AS malformed FROM customer",
    ),
    "csv_quarantined": (_quarantined, _quarantined_sql()),
    "csv_quoted_through_warehouse": (
        _quoted,
        "SELECT cast(c_custkey AS varchar) || ', \"x\"' AS \"CID\", c_name || chr(10) || '\"' || c_mktsegment || '\", end' || chr(10) AS \"CNTRY\","
        " cast(0 AS bigint) AS malformed FROM customer",
    ),
    "lineage_and_row_hash": (
        _lineage,
        f"SELECT cast(c_custkey AS varchar) AS c_custkey, '{_BATCH}' AS batch_id, '2002-03-01 00:00:00' AS loaded_at,"
        " sha256(cast(c_custkey AS varchar) || chr(31) || CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name ELSE '' END"
        " || chr(31) || c_mktsegment) AS row_hash, true AS has_file FROM customer",
    ),
    "file_row_numbers": (
        _row_numbers,
        "SELECT count(*) AS row_count, count(*) AS numbers, count(*) AS highest, cast(sum(number * l_orderkey) AS bigint) AS weight FROM"
        " (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey) AS number FROM lineitem) l",
    ),
    "csv_export": (
        _export_round_trip,
        "SELECT p_partkey, p_name || ', \"' || p_brand || '\"' AS p_name, p_brand, true AS crlf FROM part",
    ),
    "source_file_facts": (_file_facts, None),
    "written_file_facts": (
        _written_file_facts,
        """
        SELECT p_type, p_brand, CAST(sum(strlen(p_name) + 1) AS BIGINT) AS file_size_bytes
        FROM part GROUP BY p_type, p_brand
        UNION ALL SELECT 'none', 'none', CAST(0 AS BIGINT)
        """,
    ),
    "bronze_load": (
        _bronze_rows,
        f"""{with_raw("crm_cust_info", "cust_deliveries")},
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cst_id ORDER BY
  CASE WHEN cst_create_date <> '' THEN cast(cst_create_date AS date) END DESC NULLS LAST) AS rn
  FROM raw_cust_deliveries WHERE {_HAS_ID}) r WHERE rn = 1)
SELECT cst_id, cst_key, cst_create_date FROM latest UNION ALL
SELECT cst_id, cst_key, cst_create_date FROM {_FIRST} f WHERE cst_id NOT IN (SELECT cst_id FROM latest)""",
    ),
    "bronze_load_counts": (
        _load_counts,
        f"""{with_raw("crm_cust_info", "cust_deliveries")}
SELECT 'first' AS task_name, 'Success' AS task_status, count(*) AS rows_read,
  count(*) FILTER (WHERE {_HAS_ID}) AS rows_inserted, cast(0 AS bigint) AS rows_updated,
  count(*) FILTER (WHERE NOT {_HAS_ID}) AS rows_rejected FROM {_FIRST} f UNION ALL
SELECT 'second', 'Success', count(*),
  count(DISTINCT cst_id) FILTER (WHERE {_HAS_ID} AND cst_id NOT IN (SELECT cst_id FROM {_FIRST} f)),
  count(DISTINCT cst_id) FILTER (WHERE {_HAS_ID} AND cst_id IN (SELECT cst_id FROM {_FIRST} f)),
  count(*) FILTER (WHERE NOT {_HAS_ID}) FROM raw_cust_deliveries""",
    ),
    "job_log": (
        _job_log,
        f"""{with_raw("crm_cust_info", "cust_deliveries")}
SELECT 'bronze_load' AS name, 'Success' AS state, cast(NULL AS bigint) AS n UNION ALL
SELECT 'loaded', 'Info', NULL UNION ALL SELECT 'crm_cust_info', 'audited',
  (SELECT count(*) FROM {_FIRST} f) + (SELECT count(*) FROM raw_cust_deliveries)""",
    ),
    "run_resumed": (_resumed, _RESUMED_SQL),
    "layer_row_counts": (
        _layer_counts,
        "SELECT 'silver' AS schema_name, 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL"
        " SELECT 'gold', 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'gold', 'nothing', 0",
    ),
}

