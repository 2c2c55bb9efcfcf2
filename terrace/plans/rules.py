"""Which quality rules apply to which table.

``gates`` are the constraints a table must meet before it is published, the
others are recorded only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from terrace.functions.convert import iso_date, to_bigint, to_money
from terrace.operators import quality as q
from terrace.operators.quality import Rule, RuleSet

# Natural keys, and the columns of each table that must be filled.
_REQUIRED = {
    "crm_cust_info": ("cst_id", "cst_key"),
    "crm_prd_info": ("prd_id", "prd_key"),
    "crm_sales_details": ("sls_ord_num", "sls_prd_key", "sls_cust_id"),
    "erp_cust_az12": ("CID",),
    "erp_loc_a101": ("CID",),
    "erp_px_cat_g1v2": ("ID",),
}
_KEY = {
    "crm_cust_info": ("cst_id",),
    "crm_prd_info": ("prd_id",),
    "crm_sales_details": ("sls_ord_num", "sls_prd_key"),
    "erp_cust_az12": ("CID",),
    "erp_loc_a101": ("CID",),
    "erp_px_cat_g1v2": ("ID",),
}


def silver_gates(table: str) -> list[Rule]:
    return [q.primary_key(*_KEY[table]), *[q.not_null(c) for c in _REQUIRED[table]]]


def silver_rules(table: str, as_of: Column) -> list[Rule]:
    return {
        "crm_cust_info": [q.no_outer_blanks("cst_key")],
        "crm_prd_info": [
            q.no_outer_blanks("prd_nm"),
            q.not_negative("prd_cost"),
            q.ends_after_start("prd_start_dt", "prd_end_dt"),
            q.no_overlap(["prd_key"], "prd_start_dt", "prd_end_dt", tie=["prd_id"]),
        ],
        "crm_sales_details": [
            q.in_date_order("sls_order_dt", "sls_ship_dt", "sls_due_dt"),
            q.consistent_measures("sls_sales", "sls_quantity", "sls_price"),
        ],
        "erp_cust_az12": [q.date_in_range("BDATE", as_of)],
        "erp_loc_a101": [],
        "erp_px_cat_g1v2": [q.no_outer_blanks("CAT", "SUBCAT")],
    }[table]


# Raw columns a delivery must fill with readable values, where it fills them.
_READABLE = {
    "crm_cust_info": {"cst_id": to_bigint, "cst_create_date": iso_date},
    "crm_prd_info": {"prd_id": to_bigint, "prd_cost": to_money, "prd_start_dt": iso_date, "prd_end_dt": iso_date},
    "crm_sales_details": {"sls_cust_id": to_bigint, "sls_sales": to_money, "sls_quantity": to_bigint, "sls_price": to_money},
    "erp_cust_az12": {"BDATE": iso_date},
}


def bronze_rules(table: str, typed: bool = False) -> list[Rule]:
    """Recorded for the rows a load has written. Typed deliveries have no raw values left to be read."""
    rules = [q.unique_where_present(*_KEY[table])]
    if table == "crm_sales_details":
        rules += [q.valid_compact_date(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")]
    return rules if typed else rules + [q.converts(c, f) for c, f in _READABLE.get(table, {}).items()]


def gold_gates(table: str) -> list[Rule]:
    key = {"dim_customers": "customer_key", "dim_products": "product_key", "fact_sales": "sales_key"}[table]
    needed = {"dim_customers": "customer_id", "dim_products": "product_number", "fact_sales": "order_number"}[table]
    return [q.not_null(key), q.surrogate_key(key), q.not_null(needed)]


def fact_rules(dim_product: DataFrame, dim_customer: DataFrame, sales: DataFrame, versions_apply: bool) -> list[Rule | RuleSet]:
    """``sales`` are the cleaned rows the fact was made of: a row each."""
    dims = [
        ("customer_key", dim_customer, "customer_key"),
        ("product_key", dim_product, "product_key"),
    ]
    rules: list[Rule | RuleSet] = [q.relations(dims, sales)]
    if versions_apply:
        rules.append(q.unique_together("order_number", "product_key"))
    return rules
