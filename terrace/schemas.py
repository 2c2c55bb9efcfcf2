"""Declared sources and table schemas of all layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

from terrace.operators.conform import field, varchar

TEXT, INT, LONG = StringType(), IntegerType(), LongType()
DATE, TIMESTAMP, FLAG = DateType(), TimestampType(), BooleanType()
MONEY, SECONDS = DecimalType(19, 4), DecimalType(18, 4)

LAYERS = ("staging", "bronze", "silver", "gold", "ops")


@dataclass(frozen=True)
class Source:
    """A delivered file: its table, columns, natural key, date deciding ties."""

    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    latest_by: str | None = None


# The delivered files and their columns.
SOURCES = (
    Source(
        "crm_cust_info",
        ("cst_id", "cst_key", "cst_firstname", "cst_lastname",
         "cst_marital_status", "cst_gndr", "cst_create_date"),
        ("cst_id",),
        "cst_create_date",
    ),
    Source(
        "crm_prd_info",
        ("prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt"),
        ("prd_id",),
    ),
    Source(
        "crm_sales_details",
        ("sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt",
         "sls_due_dt", "sls_sales", "sls_quantity", "sls_price"),
        ("sls_ord_num", "sls_prd_key"),
    ),
    Source("erp_cust_az12", ("CID", "BDATE", "GEN"), ("CID",)),
    Source("erp_loc_a101", ("CID", "CNTRY"), ("CID",)),
    Source("erp_px_cat_g1v2", ("ID", "CAT", "SUBCAT", "MAINTENANCE"), ("ID",)),
)
SOURCE_BY_NAME = {s.name: s for s in SOURCES}

LINEAGE = StructType(
    [
        field("batch_id", TEXT, False),
        field("source_file", TEXT, False),
        field("source_row_number", LONG, False),
        field("loaded_at", TIMESTAMP, False),
        field("row_hash", BinaryType(), False),
    ]
)
LINEAGE_COLUMNS = tuple(LINEAGE.names)


def raw_schema(source: Source) -> StructType:
    """Bronze and staging: text as delivered, of any length, plus lineage."""
    return StructType([field(c, TEXT) for c in source.columns] + LINEAGE.fields)


_TYPED = {
    f.name: f
    for f in (
        field("cst_id", INT), field("cst_create_date", DATE), field("prd_id", INT), field("prd_cost", INT),
        field("prd_start_dt", TIMESTAMP), field("prd_end_dt", TIMESTAMP), field("sls_cust_id", INT),
        field("sls_order_dt", INT), field("sls_ship_dt", INT), field("sls_due_dt", INT),
        field("sls_sales", INT), field("sls_quantity", INT), field("sls_price", INT), field("BDATE", DATE),
    )
}


def typed_schema(source: Source) -> StructType:
    """Column types for deliveries that are loaded typed instead of as text."""
    return StructType([_TYPED.get(c, field(c, TEXT)) for c in source.columns])


_STAMPS = [field("meta_created_at", TIMESTAMP, False), field("meta_updated_at", TIMESTAMP, False)]

SILVER = {
    "crm_cust_info": StructType(
        [field("cst_id", INT, False), varchar("cst_key", 20), varchar("cst_firstname", 100),
         varchar("cst_lastname", 100), varchar("cst_marital_status", 10), varchar("cst_gndr", 10),
         field("cst_create_date", DATE), *_STAMPS]
    ),
    "crm_prd_info": StructType(
        [field("prd_id", INT, False), varchar("prd_category", 50), varchar("prd_key", 50),
         varchar("prd_nm", 255), field("prd_cost", MONEY), varchar("prd_line", 15),
         field("prd_start_dt", DATE), field("prd_end_dt", DATE), *_STAMPS]
    ),
    "crm_sales_details": StructType(
        [varchar("sls_ord_num", 20, False), varchar("sls_prd_key", 50, False),
         field("sls_cust_id", INT, False), field("sls_order_dt", DATE), field("sls_ship_dt", DATE),
         field("sls_due_dt", DATE), field("sls_sales", MONEY), field("sls_quantity", INT),
         field("sls_price", MONEY), *_STAMPS]
    ),
    "erp_cust_az12": StructType(
        [varchar("CID", 20, False), field("BDATE", DATE), varchar("GEN", 10), *_STAMPS]
    ),
    "erp_loc_a101": StructType([varchar("CID", 20, False), varchar("CNTRY", 50), *_STAMPS]),
    "erp_px_cat_g1v2": StructType(
        [varchar("ID", 20, False), varchar("CAT", 50), varchar("SUBCAT", 50),
         field("MAINTENANCE", FLAG), *_STAMPS]
    ),
}
SILVER_KEYS = {s.name: s.keys for s in SOURCES}

# Surrogate keys are 64-bit: a fact table outgrows 32 bits.
GOLD = {
    "dim_customers": StructType(
        [field("customer_key", LONG, False), field("customer_id", INT),
         varchar("customer_number", 50), varchar("first_name", 50), varchar("last_name", 50),
         varchar("full_name", 100), varchar("country", 50), varchar("marital_status", 20),
         varchar("gender", 20), field("birthdate", DATE), field("create_date", DATE),
         field("age", INT), varchar("age_group", 20), field("meta_created_at", TIMESTAMP, False)]
    ),
    "dim_products": StructType(
        [field("product_key", LONG, False), field("product_id", INT), varchar("product_number", 50),
         varchar("product_name", 255), varchar("category_id", 20), varchar("category_name", 50),
         varchar("subcategory_name", 50), varchar("maintenance_flag", 10), field("product_cost", MONEY),
         varchar("product_line", 50), field("start_date", DATE), field("end_date", DATE),
         field("is_current", FLAG), field("meta_created_at", TIMESTAMP, False)]
    ),
    "fact_sales": StructType(
        [field("sales_key", LONG, False), field("customer_key", LONG), field("product_key", LONG),
         varchar("order_number", 20), field("order_date", DATE), field("shipping_date", DATE),
         field("due_date", DATE), field("sales_amount", MONEY), field("quantity", INT),
         field("price", MONEY), field("meta_created_at", TIMESTAMP, False)]
    ),
}

# The allowed states of runs, checks and alerts.
RUN_STATES = ("Running", "Success", "Failed")
CHECK_STATES = ("Pass", "Warn", "Fail")
SEVERITIES = ("Info", "Warning", "Critical")

OPS = {
    "job_runs": StructType(
        [field("job_run_id", TEXT, False), field("pipeline_name", TEXT, False),
         field("pl_status", TEXT, False), field("started_at", TIMESTAMP, False),
         field("ended_at", TIMESTAMP), field("duration_sec", SECONDS), field("status_message", TEXT)]
    ),
    "task_runs": StructType(
        [field("task_run_id", TEXT, False), field("job_run_id", TEXT, False),
         field("task_name", TEXT, False), field("task_status", TEXT, False),
         field("started_at", TIMESTAMP, False), field("ended_at", TIMESTAMP),
         field("duration_sec", SECONDS), field("rows_read", LONG), field("rows_inserted", LONG),
         field("rows_updated", LONG), field("rows_rejected", LONG), field("status_message", TEXT)]
    ),
    "source_file_audit": StructType(
        [field("source_file_audit_id", TEXT, False), field("job_run_id", TEXT, False),
         field("source_name", TEXT, False), field("source_file", TEXT, False),
         field("file_size_bytes", LONG), field("row_count", LONG),
         field("file_modified_at", TIMESTAMP), field("loaded_at", TIMESTAMP, False)]
    ),
    "data_quality_results": StructType(
        [field("data_quality_result_id", TEXT, False), field("job_run_id", TEXT),
         field("model_name", TEXT, False), field("test_name", TEXT, False),
         field("test_status", TEXT, False), field("failed_row_count", LONG),
         field("checked_at", TIMESTAMP, False), field("details", TEXT)]
    ),
    "table_row_counts": StructType(
        [field("table_row_count_id", TEXT, False), field("job_run_id", TEXT),
         field("schema_name", TEXT, False), field("table_name", TEXT, False),
         field("row_count", LONG, False), field("captured_at", TIMESTAMP, False)]
    ),
    "alerts": StructType(
        [field("alert_id", TEXT, False), field("job_run_id", TEXT), field("severity", TEXT, False),
         field("channel", TEXT), field("alert_subject", TEXT, False), field("alert_message", TEXT),
         field("created_at", TIMESTAMP, False), field("sent_at", TIMESTAMP)]
    ),
}
