"""Gold star schema: two dimensions and the sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.convert import flag_of
from terrace.functions.measures import banded, completed_age
from terrace.functions.text import first_known, joined
from terrace.operators.history import (
    current_only,
    join_current,
    join_version_in_force,
)
from terrace.operators.joins import enriched
from terrace.operators.keys import dense_key
from terrace.plans.presets import INCREMENTAL, Preset


def customer_attributes(
    customers: DataFrame, births: DataFrame, places: DataFrame, as_of: Column, preset: Preset = INCREMENTAL
) -> DataFrame:
    """Customers with birth date, gender and country; not yet numbered."""
    rows = enriched(customers, births, {"cst_key": "CID"}, {"BDATE": "_born", "GEN": "_gender"})
    rows = enriched(rows, places, {"cst_key": "CID"}, {"CNTRY": "_country"})
    gender = first_known(F.col("cst_gndr"), F.col("_gender"), preset.unknown)
    country, status = F.col("_country"), F.col("cst_marital_status")
    if preset.with_age:
        country, status = F.coalesce(country, F.lit("n/a")), F.coalesce(status, F.lit("n/a"))
    columns = [
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
    ]
    if preset.with_age:
        full = joined(F.col("cst_firstname"), F.col("cst_lastname"))
        columns.append(full.alias("full_name"))
    columns += [
        country.alias("country"),
        status.alias("marital_status"),
        gender.alias("gender"),
        F.col("_born").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"),
    ]
    if preset.with_age:
        age = completed_age(F.col("_born"), as_of)
        columns += [age.alias("age"), banded(age).alias("age_group")]
    return rows.select(*columns)


def dim_customers(
    customers: DataFrame, births: DataFrame, places: DataFrame, as_of: Column, preset: Preset = INCREMENTAL
) -> DataFrame:
    rows = customer_attributes(customers, births, places, as_of, preset)
    return dense_key(rows, ["customer_id", "customer_number"], "customer_key")


def product_attributes(products: DataFrame, categories: DataFrame, preset: Preset = INCREMENTAL) -> DataFrame:
    """Product versions, or current products, with their category."""
    rows = current_only(products, "prd_end_dt") if preset.current_products else products
    rows = enriched(
        rows,
        categories,
        {"prd_category": "ID"},
        {"ID": "_category", "CAT": "category_name", "SUBCAT": "subcategory_name", "MAINTENANCE": "_serviced"},
    )
    common = [
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
    ]
    if preset.current_products:
        return rows.select(
            *common,
            F.col("prd_category").alias("category_id"),
            F.col("category_name").alias("category"),
            F.col("subcategory_name").alias("subcategory"),
            F.col("_serviced").alias("maintenance"),
            F.col("prd_cost").alias("cost"),
            F.col("prd_line").alias("product_line"),
            F.col("prd_start_dt").alias("start_date"),
        )
    return rows.select(
        *common,
        F.col("_category").alias("category_id"),
        "category_name",
        "subcategory_name",
        F.when(flag_of(F.col("_serviced")), "Yes").otherwise("No").alias("maintenance_flag"),
        F.col("prd_cost").alias("product_cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
        F.col("prd_end_dt").alias("end_date"),
        F.col("prd_end_dt").isNull().alias("is_current"),
    )


def dim_products(products: DataFrame, categories: DataFrame, preset: Preset = INCREMENTAL) -> DataFrame:
    order = ["product_id", "start_date"]
    if preset.current_products:
        order = ["start_date", "product_number", "product_id"]
    return dense_key(product_attributes(products, categories, preset), order, "product_key")


def sales_with_keys(
    sales: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    preset: Preset = INCREMENTAL,
) -> DataFrame:
    """Sales rows with the keys of product version and customer, or NULL.

    Customers come first, while the rows of an order lie together and compress well.
    """
    sales = enriched(sales, dim_customer, {"sls_cust_id": "customer_id"}, {"customer_key": "customer_key"})
    if preset.current_products:
        versions = dim_product.select("product_key", "product_number")
        rows = join_current(sales, versions, "sls_prd_key", "product_number")
    else:
        versions = dim_product.select("product_key", "product_number", "start_date", "end_date")
        rows = join_version_in_force(
            sales, versions, "sls_prd_key", "product_number",
            "sls_order_dt", "start_date", "end_date",
        )
    return rows.select(
        "customer_key",
        "product_key",
        F.col("sls_ord_num").alias("order_number"),
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
        F.col("sls_prd_key").alias("_product_number"),
    )


def fact_sales(
    sales: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    preset: Preset = INCREMENTAL,
) -> DataFrame:
    """The fact; the current-products variant carries no key of its own."""
    rows = sales_with_keys(sales, dim_product, dim_customer, preset)
    if preset.current_products:
        return rows.drop("_product_number")
    order = ["order_number", "_product_number", "product_key", "customer_key"]
    return dense_key(rows, order, "sales_key", unwritten=["_product_number"])
