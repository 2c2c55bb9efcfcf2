"""Inputs of the registered queries: the shared tables and raw extracts of them.

The extracts turn the whole tables into the dirty text deliveries the silver
models expect. Their SQL is the same for Spark and for the comparison; dirt
follows from values of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampType

from terrace.session import configured

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
# All tables that are given.
GIVEN = (*TABLES, "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# The day ages and future dates are judged on.
AS_OF = "2002-03-01"


def as_of():
    return F.lit(AS_OF).cast("date")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configured(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Dates and instants as text, decimals as doubles."""
    columns = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, (DateType, TimestampType)):
            c = c.cast("string")
        elif isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        columns.append(c.alias(f.name))
    return df.select(*columns)


# Dirty text columns beside the keys of each line item.
DIRTY_LINES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN '  ' || qty || ' ' WHEN 3 THEN 'x' || qty
    WHEN 4 THEN NULL WHEN 5 THEN qty || '.5' WHEN 6 THEN '   ' ELSE qty END AS raw_number,
  CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN ' ' || price || ' ' WHEN 3 THEN '1e3'
    WHEN 4 THEN NULL WHEN 5 THEN '-' || price WHEN 6 THEN '$' || price ELSE price END AS raw_money,
  CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN '2001-02-30' WHEN 3 THEN '2001-2-3'
    WHEN 4 THEN NULL WHEN 5 THEN ' ' || day || ' ' WHEN 6 THEN '2001' ELSE day END AS raw_day,
  CASE l_linenumber WHEN 1 THEN '0' WHEN 2 THEN '2010' WHEN 3 THEN '20010230'
    WHEN 4 THEN NULL WHEN 5 THEN ' ' || compact || ' ' WHEN 6 THEN '18991231' ELSE compact END AS raw_compact,
  CASE l_linenumber WHEN 1 THEN lower(l_returnflag) WHEN 2 THEN ' ' || l_returnflag || ' '
    WHEN 3 THEN '?' WHEN 4 THEN NULL WHEN 5 THEN '' ELSE l_returnflag END AS raw_code,
  CASE WHEN l_linestatus = 'F' THEN 'NAS' || l_returnflag || qty
    ELSE l_returnflag || '-' || qty || '-0' END AS raw_key,
  l_returnflag || l_linestatus || '-' || l_returnflag || l_returnflag || '-' || qty || '-U' AS composite,
  CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 2 THEN -units * 3
    WHEN l_returnflag = 'A' THEN units * 7 + 1 ELSE units * 7 END AS sales,
  CASE WHEN l_linenumber = 3 THEN 0 WHEN l_linenumber = 7 THEN NULL ELSE units END AS quantity,
  CASE WHEN l_linenumber = 4 THEN NULL WHEN l_linenumber = 5 THEN -7 ELSE 7 END AS price,
  ship_day
FROM (
  SELECT *, cast(l_quantity AS int) AS units, cast(cast(l_quantity AS int) AS string) AS qty,
    cast(cast(l_extendedprice AS decimal(19,2)) AS string) AS price,
    cast(cast(l_shipdate AS date) AS string) AS day, cast(l_shipdate AS date) AS ship_day,
    replace(cast(cast(l_shipdate AS date) AS string), '-', '') AS compact
  FROM {lineitem}
) lines
"""

_CUSTOMER_COLUMNS = """
  CASE WHEN c_nationkey = 7 THEN 'x' || id WHEN c_mktsegment = 'FURNITURE' THEN ' ' || id || ' ' ELSE id END AS cst_id,
  CASE WHEN c_nationkey = 9 THEN '  ' ELSE code || ' ' END AS cst_key,
  ' ' || c_mktsegment || ' ' AS cst_firstname,
  CASE WHEN c_nationkey = 3 THEN '' ELSE 'N' || nation END AS cst_lastname,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'm ' WHEN 'BUILDING' THEN 'S' WHEN 'AUTOMOBILE' THEN 'X'
    WHEN 'FURNITURE' THEN '' ELSE NULL END AS cst_marital_status,
  CASE WHEN c_nationkey < 8 THEN ' f' WHEN c_nationkey < 16 THEN 'M' WHEN c_nationkey < 20 THEN '' ELSE NULL END AS cst_gndr"""
_NAMED_CUSTOMERS = """
  SELECT *, cast(c_custkey AS string) AS id, 'AW' || substr(c_name, 10) AS code,
    cast(c_nationkey AS string) AS nation, lpad(cast(c_nationkey + 4 AS string), 2, '0') AS nation_day
  FROM {customer}"""

RAW = {
    "crm_cust_info": f"""
SELECT {_CUSTOMER_COLUMNS},
  CASE WHEN c_nationkey = 24 THEN '2020-02-30' ELSE '2020-01-' || nation_day END AS cst_create_date
FROM ({_NAMED_CUSTOMERS}) c
""",
    # The customer is delivered again with each order.
    "cust_deliveries": f"""
SELECT {_CUSTOMER_COLUMNS},
  CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE cast(cast(o_orderdate AS date) AS string) END AS cst_create_date
FROM ({_NAMED_CUSTOMERS}) c JOIN {{orders}} o ON o_custkey = c_custkey
""",
    # A version of each part begins with every year it was shipped in.
    "crm_prd_info": """
SELECT cast(p_partkey * 100 + yr - 1990 AS string) AS prd_id,
  ' ' || substr(p_type, 1, 2) || '-' || lpad(substr(p_brand, 7), 2, '0') || '-P' || cast(p_partkey AS string) AS prd_key,
  p_name || ' ' AS prd_nm,
  CASE WHEN p_size = 1 THEN '' WHEN p_size = 2 THEN '1e3' WHEN p_size = 3 THEN 'n/a'
    ELSE cast(cast(p_retailprice AS decimal(19,2)) AS string) END AS prd_cost,
  CASE p_type WHEN 'STANDARD' THEN 'M ' WHEN 'LARGE' THEN 's' WHEN 'MEDIUM' THEN 'R' WHEN 'SMALL' THEN ' T'
    WHEN 'PROMO' THEN 'x' ELSE NULL END AS prd_line,
  cast(yr AS string) || '-01-01' AS prd_start_dt,
  CASE WHEN p_size < 25 THEN cast(yr - 1 AS string) || '-06-30' WHEN p_size < 40 THEN cast(yr AS string) || '-06-30'
    ELSE '' END AS prd_end_dt
FROM {part} JOIN (SELECT DISTINCT l_partkey, year(l_shipdate) AS yr FROM {lineitem}) v ON l_partkey = p_partkey
""",
    # One row per order and part.
    "crm_sales_details": """
SELECT ' SO' || cast(l_orderkey AS string) AS sls_ord_num, 'P' || cast(l_partkey AS string) AS sls_prd_key,
  CASE WHEN line = 7 AND o_orderstatus = 'P' THEN 'unknown' ELSE cast(o_custkey AS string) END AS sls_cust_id,
  CASE WHEN line = 1 AND o_orderpriority = '1-URGENT' THEN '0' WHEN line = 2 AND o_orderpriority = '2-HIGH' THEN '2010'
    ELSE replace(cast(cast(o_orderdate AS date) AS string), '-', '') END AS sls_order_dt,
  replace(cast(cast(ship AS date) AS string), '-', '') AS sls_ship_dt,
  replace(cast(cast(cast(ship AS date) + interval '7' day AS date) AS string), '-', '') AS sls_due_dt,
  CASE WHEN line = 2 THEN '' WHEN line = 3 THEN '-' || cast(units * unit_price AS string)
    WHEN line = 4 THEN cast(units * unit_price + 1 AS string) ELSE cast(units * unit_price AS string) END AS sls_sales,
  CASE WHEN line = 6 AND o_orderstatus = 'F' THEN '0' ELSE ' ' || cast(units AS string) END AS sls_quantity,
  CASE WHEN line = 4 THEN '' WHEN line = 5 THEN '-' || cast(unit_price AS string)
    ELSE cast(unit_price AS string) END AS sls_price
FROM (
  SELECT l_orderkey, l_partkey, max(l_linenumber) AS line, max(l_shipdate) AS ship,
    max(cast(l_quantity AS int)) AS units, max(cast(l_tax * 100 AS int)) + 5 AS unit_price
  FROM {lineitem} GROUP BY l_orderkey, l_partkey
) l JOIN {orders} ON o_orderkey = l_orderkey
""",
    "erp_cust_az12": f"""
SELECT CASE WHEN c_nationkey = 11 THEN ' ' WHEN c_mktsegment = 'HOUSEHOLD' THEN code ELSE 'NAS' || code END AS CID,
  CASE WHEN c_nationkey = 24 THEN '2999-01-01' WHEN c_nationkey = 12 THEN ''
    WHEN c_mktsegment = 'BUILDING' THEN cast(1940 + c_nationkey * 2 AS string) || '-02-29'
    ELSE cast(1940 + c_nationkey * 2 AS string) || '-03-01' END AS BDATE,
  CASE WHEN c_nationkey < 5 THEN 'Male' WHEN c_nationkey < 10 THEN 'F ' WHEN c_nationkey < 15 THEN ''
    WHEN c_nationkey < 20 THEN ' female' ELSE NULL END AS GEN
FROM ({_NAMED_CUSTOMERS}) c
""",
    "erp_loc_a101": f"""
SELECT CASE WHEN c_nationkey = 13 THEN NULL ELSE substr(code, 1, 2) || '-' || substr(code, 3) END AS CID,
  CASE c_nationkey WHEN 0 THEN ' US ' WHEN 1 THEN 'USA' WHEN 2 THEN 'DE' WHEN 3 THEN ' ' WHEN 4 THEN NULL
    ELSE n_name END AS CNTRY
FROM ({_NAMED_CUSTOMERS}) c JOIN {{nation}} ON n_nationkey = c_nationkey
""",
    "erp_px_cat_g1v2": """
SELECT DISTINCT substr(p_type, 1, 2) || '_' || lpad(substr(p_brand, 7), 2, '0') AS ID,
  ' ' || p_type AS CAT, p_brand || ' ' AS SUBCAT,
  CASE WHEN p_brand < 'Brand#15' THEN 'Yes ' WHEN p_brand < 'Brand#3' THEN 'No' ELSE 'maybe' END AS MAINTENANCE
FROM {part} WHERE p_type <> 'PROMO'
""",
}


def _names(text: str) -> list[str]:
    return [t for t in TABLES if "{" + t + "}" in text]


def from_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    inputs = {t: table(spark, sf_dir, t) for t in _names(text)}
    return spark.sql(text, **inputs)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    inputs = {t: table(spark, sf_dir, t) for t in _names(RAW[name])}
    if name == "crm_sales_details":
        # Line items are dealt by order once: so dealt they are grouped by order and part, and joined to the orders.
        inputs["lineitem"] = inputs["lineitem"].repartition("l_orderkey")
    return spark.sql(RAW[name], **inputs)


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_sql(spark, sf_dir, DIRTY_LINES)


def plain(text: str) -> str:
    """The same text for an engine that knows the tables by name."""
    for t in _names(text):
        text = text.replace("{" + t + "}", t)
    return text


def with_raw(*names: str, as_text: bool = False) -> str:
    """A WITH list defining raw extracts as ``raw_<name>``; ``as_text`` as a file holds them, NULL being empty."""
    given = "SELECT coalesce(COLUMNS(*), '') FROM ({}) d" if as_text else "{}"
    parts = [f"raw_{n} AS ({given.format(plain(RAW[n]))})" for n in names]
    return "WITH " + ",\n".join(parts)


WITH_DIRTY = f"WITH dirty AS ({plain(DIRTY_LINES)})"


# Comparison SQL of expressions several queries share. Code lists are written
# out here once more and looked up in a table, so that a wrong code in the
# presets does not agree with itself.
MARITAL_CODES = (("S", "Single"), ("M", "Married"))
GENDER_CODES = (("F", "Female"), ("M", "Male"))
GENDER_WORDS = (("F", "Female"), ("FEMALE", "Female"), ("M", "Male"), ("MALE", "Male"))
LINE_CODES = (("M", "Mountain"), ("R", "Road"), ("S", "Other Sales"), ("T", "Touring"))
COUNTRIES_DENMARK = (("DE", "Denmark"), ("US", "United States"), ("USA", "United States"))
COUNTRIES_GERMANY = (("DE", "Germany"), ("US", "United States"), ("USA", "United States"))


def sql_lookup(value: str, codes, default: str) -> str:
    """The meaning of a code by a lookup table, or ``default`` (an SQL expression)."""
    rows = ", ".join(f"('{code}', '{meaning}')" for code, meaning in codes)
    found = f"SELECT meaning FROM (VALUES {rows}) AS codes(code, meaning) WHERE code = {value}"
    return f"coalesce(({found}), {default})"


def sql_band(age: str) -> str:
    return (
        f"CASE WHEN {age} IS NULL THEN 'Unknown' WHEN {age} < 20 THEN 'Under 20' WHEN {age} <= 29 THEN '20-29'"
        f" WHEN {age} <= 39 THEN '30-39' WHEN {age} <= 49 THEN '40-49' ELSE '50+' END"
    )


def sql_age(birth: str, day: str = AS_OF) -> str:
    to_come = f"(month({birth}), day({birth})) > (month(DATE '{day}'), day(DATE '{day}'))"
    return f"cast(year(DATE '{day}') - year({birth}) - CASE WHEN {to_come} THEN 1 ELSE 0 END AS integer)"


def sql_sales(sales: str, quantity: str, price: str) -> str:
    return (
        f"CASE WHEN {sales} IS NULL OR {sales} <= 0 OR {sales} <> {quantity} * abs({price})"
        f" THEN {quantity} * abs({price}) ELSE {sales} END"
    )


def sql_price(sales: str, quantity: str, price: str) -> str:
    repaired = f"CASE WHEN {quantity} <> 0 THEN {sales} // {quantity} END"
    return f"cast(CASE WHEN {price} IS NULL OR {price} <= 0 THEN {repaired} ELSE {price} END AS integer)"


def sql_broken_measures(sales: str, quantity: str, price: str) -> str:
    missing = " OR ".join(f"{c} IS NULL OR {c} <= 0" for c in (sales, quantity, price))
    return f"({missing} OR {sales} <> {quantity} * {price})"
