"""Silver models: one function per source, raw rows in, typed rows out.

All of them are projections and filters of one scan, except the product
history (one window over each product) and the optional choice of the latest
customer row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.convert import (
    compact_date,
    day_of,
    int_or_zero,
    iso_date,
    money_or_zero,
    to_flag,
    to_int,
    to_money,
)
from terrace.functions.measures import repaired_price, repaired_sales, unless_after
from terrace.functions.text import (
    category_of,
    clipped,
    decoded,
    is_present,
    number_of,
    text,
    text_field,
    trimmed,
    without,
    without_prefix,
)
from terrace.operators.dedup import keep_latest_date
from terrace.operators.history import with_end_dates
from terrace.plans.presets import (
    GENDER,
    GENDER_OR_WORD,
    INCREMENTAL,
    MARITAL_STATUS,
    PRODUCT_LINE,
    Preset,
)


def _day(df: DataFrame, c: str) -> Column:
    """A date delivered as text or already typed."""
    return iso_date(F.col(c)) if dict(df.dtypes)[c] == "string" else day_of(F.col(c))


def customers(raw: DataFrame, preset: Preset = INCREMENTAL) -> DataFrame:
    number = to_int(F.col("cst_id"))
    rows = raw.filter(number.isNotNull())
    if preset.typed_delivery:
        key = text(F.col("cst_key"))
        first, last = trimmed(F.col("cst_firstname")), trimmed(F.col("cst_lastname"))
    else:
        rows = rows.filter(is_present(F.col("cst_key")))
        key = text_field(F.col("cst_key"), 20)
        first = text_field(F.col("cst_firstname"), 100)
        last = text_field(F.col("cst_lastname"), 100)
    typed = rows.select(
        number.alias("cst_id"),
        key.alias("cst_key"),
        first.alias("cst_firstname"),
        last.alias("cst_lastname"),
        decoded(F.col("cst_marital_status"), MARITAL_STATUS, preset.unknown).alias("cst_marital_status"),
        decoded(F.col("cst_gndr"), GENDER, preset.unknown).alias("cst_gndr"),
        _day(raw, "cst_create_date").alias("cst_create_date"),
    )
    return keep_latest_date(typed, ["cst_id"], "cst_create_date") if preset.latest_customer else typed


def products(raw: DataFrame, preset: Preset = INCREMENTAL) -> DataFrame:
    number = to_int(F.col("prd_id"))
    if preset.typed_delivery:
        rows = raw
        composite, name = text(F.col("prd_key")), text(F.col("prd_nm"))
        cost = F.coalesce(to_money(F.col("prd_cost")), F.lit(0).cast("decimal(19,4)")).cast("int")
    else:
        rows = raw.filter(number.isNotNull() & is_present(F.col("prd_key")))
        composite, name = trimmed(F.col("prd_key")), text_field(F.col("prd_nm"), 255)
        cost = money_or_zero(F.col("prd_cost"))
    typed = rows.select(
        number.alias("prd_id"),
        category_of(composite).alias("prd_category"),
        clipped(number_of(composite), 50).alias("prd_key"),
        name.alias("prd_nm"),
        cost.alias("prd_cost"),
        decoded(F.col("prd_line"), PRODUCT_LINE, preset.unknown_line).alias("prd_line"),
        _day(raw, "prd_start_dt").alias("prd_start_dt"),
        _day(raw, "prd_end_dt").alias("prd_end_dt"),
        composite.alias("_composite"),
    )
    closed = with_end_dates(
        typed, ["_composite"], "prd_start_dt", "prd_end_dt", tie=["prd_id"], mode=preset.end_mode
    )
    return closed.drop("_composite")


def sales(raw: DataFrame, preset: Preset = INCREMENTAL) -> DataFrame:
    buyer = to_int(F.col("sls_cust_id"))
    days = [compact_date(F.col(c)).alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")]
    if preset.typed_delivery:
        amount, pieces, price = (to_int(F.col(c)) for c in ("sls_sales", "sls_quantity", "sls_price"))
        rows, order, product = raw, text(F.col("sls_ord_num")), text(F.col("sls_prd_key"))
    else:
        amount, price = money_or_zero(F.col("sls_sales")), money_or_zero(F.col("sls_price"))
        pieces = int_or_zero(F.col("sls_quantity"))
        rows = raw.filter(
            is_present(F.col("sls_ord_num")) & is_present(F.col("sls_prd_key")) & buyer.isNotNull()
        )
        order, product = text_field(F.col("sls_ord_num"), 20), text_field(F.col("sls_prd_key"), 50)
    typed = rows.select(
        order.alias("sls_ord_num"),
        product.alias("sls_prd_key"),
        buyer.alias("sls_cust_id"),
        *days,
        amount.alias("sls_sales"),
        pieces.alias("sls_quantity"),
        price.alias("sls_price"),
    )
    if not preset.repair_amounts:
        return typed
    measures = (F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price"))
    return typed.withColumns(
        {"sls_sales": repaired_sales(*measures), "sls_price": repaired_price(*measures)}
    )


def birth_facts(raw: DataFrame, preset: Preset = INCREMENTAL, as_of: Column | None = None) -> DataFrame:
    as_of = F.current_date() if as_of is None else as_of
    born = _day(raw, "BDATE")
    if preset.null_future_births:
        born = unless_after(born, as_of)
    gender = text_field(F.col("GEN"), 10)
    if preset.decode_birth_gender:
        gender = decoded(F.col("GEN"), GENDER_OR_WORD, preset.unknown)
    if preset.typed_delivery:
        rows, key = raw, without_prefix(F.col("CID"), "NAS")
    else:
        rows = raw.filter(is_present(F.col("CID")))
        key = clipped(without_prefix(trimmed(F.col("CID")), "NAS"), 20)
    return rows.select(key.alias("CID"), born.alias("BDATE"), gender.alias("GEN"))


def locations(raw: DataFrame, preset: Preset = INCREMENTAL) -> DataFrame:
    place = trimmed(F.col("CNTRY"))
    if preset.blank_country is not None:
        place = F.when(is_present(F.col("CNTRY")), place).otherwise(preset.blank_country)
    country = decoded(F.col("CNTRY"), preset.countries, place, fold_case=False)
    if preset.typed_delivery:
        rows, key = raw, without(F.col("CID"), "-")
    else:
        rows = raw.filter(is_present(F.col("CID")))
        key = clipped(without(trimmed(F.col("CID")), "-"), 20)
    return rows.select(key.alias("CID"), clipped(country, 50).alias("CNTRY"))


def categories(raw: DataFrame, preset: Preset = INCREMENTAL) -> DataFrame:
    if preset.typed_delivery:
        return raw.select(*[text(F.col(c)).alias(c) for c in ("ID", "CAT", "SUBCAT", "MAINTENANCE")])
    serviced = F.col("MAINTENANCE")
    serviced = to_flag(serviced) if preset.maintenance_as_flag else text_field(serviced, 50)
    return raw.filter(is_present(F.col("ID"))).select(
        text_field(F.col("ID"), 20).alias("ID"),
        text_field(F.col("CAT"), 50).alias("CAT"),
        text_field(F.col("SUBCAT"), 50).alias("SUBCAT"),
        serviced.alias("MAINTENANCE"),
    )


MODELS = {
    "crm_cust_info": customers,
    "crm_prd_info": products,
    "crm_sales_details": sales,
    "erp_cust_az12": birth_facts,
    "erp_loc_a101": locations,
    "erp_px_cat_g1v2": categories,
}


def build(name: str, raw: DataFrame, preset: Preset, as_of: Column) -> DataFrame:
    if name == "erp_cust_az12":
        return birth_facts(raw, preset, as_of)
    return MODELS[name](raw, preset)
