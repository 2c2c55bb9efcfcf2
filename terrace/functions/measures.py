"""Derived measures: ages, bands, repaired amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The age bands of the customer dimension, (from, to, label).
AGE_BANDS = (
    (None, 19, "Under 20"),
    (20, 29, "20-29"),
    (30, 39, "30-39"),
    (40, 49, "40-49"),
    (50, None, "50+"),
)


def completed_age(birth: Column, as_of: Column) -> Column:
    """Whole years lived on ``as_of``; a 29 February birthday falls on the 28th."""
    years = F.year(as_of) - F.year(birth)
    anniversary = F.add_months(birth, years * 12)
    return years - F.when(anniversary > as_of, 1).otherwise(0)


def banded(value: Column, bands: Sequence[tuple] = AGE_BANDS, unknown: str = "Unknown") -> Column:
    chain = None
    for low, high, label in bands:
        if low is None:
            test = value <= high
        elif high is None:
            test = value >= low
        else:
            test = value.between(low, high)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(unknown)


def unless_after(value: Column, limit: Column) -> Column:
    """The value, or NULL when it lies beyond the limit."""
    return F.when(value > limit, F.lit(None)).otherwise(value)


def repaired_sales(sales: Column, quantity: Column, price: Column) -> Column:
    """Quantity times absolute price where sales is missing, <= 0 or inconsistent."""
    expected = quantity * F.abs(price)
    broken = sales.isNull() | (sales <= 0) | (sales != expected)
    return F.when(broken, expected).otherwise(sales)


def repaired_price(sales: Column, quantity: Column, price: Column) -> Column:
    """Whole-unit sales per piece where price is missing or <= 0.

    ``sales`` is the amount as delivered, not the repaired one.
    """
    per_piece = whole_quotient(sales, quantity)
    return F.when(price.isNull() | (price <= 0), per_piece).otherwise(price)


def whole_quotient(numerator: Column, denominator: Column) -> Column:
    """Integer division, NULL for a zero divisor."""
    divisor = F.nullif(denominator, F.lit(0))
    return F.call_function("div", numerator, divisor).cast("int")
