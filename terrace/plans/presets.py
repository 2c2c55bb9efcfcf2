"""The three variants of the warehouse as settings of one set of models.

``INCREMENTAL`` upserts and keeps every product version, ``REBUILT`` derives
the same tables from scratch, ``CURRENT`` reads typed deliveries, repairs
amounts and shows current products only. Single settings can be changed with
``dataclasses.replace``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# Code lists of the sources.
MARITAL_STATUS = {"S": "Single", "M": "Married"}
GENDER = {"M": "Male", "F": "Female"}
GENDER_OR_WORD = {"M": "Male", "MALE": "Male", "F": "Female", "FEMALE": "Female"}
PRODUCT_LINE = {"M": "Mountain", "S": "Other Sales", "R": "Road", "T": "Touring"}
COUNTRY_DENMARK = {"US": "United States", "USA": "United States", "DE": "Denmark"}
COUNTRY_GERMANY = {"US": "United States", "USA": "United States", "DE": "Germany"}


@dataclass(frozen=True)
class Preset:
    name: str
    # Silver.
    unknown: str = "UnKnown"
    unknown_line: str = "N/A"
    countries: Mapping[str, str] = field(default_factory=lambda: dict(COUNTRY_DENMARK))
    blank_country: str | None = None  # None: the blank passes through
    typed_delivery: bool = False  # keys as delivered, whole amounts, no key filter
    typed_bronze: bool = False  # bronze holds typed rows and is replaced by each load
    latest_customer: bool = False
    end_mode: str = "repair"
    repair_amounts: bool = False
    decode_birth_gender: bool = False
    null_future_births: bool = False
    maintenance_as_flag: bool = True
    # Gold.
    with_age: bool = True
    current_products: bool = False
    # Loading.
    upsert_silver: bool = False
    declared_lengths: bool = True  # texts of silver and gold longer than declared fail the run


INCREMENTAL = Preset("incremental", upsert_silver=True)
REBUILT = Preset("rebuilt", declared_lengths=False)
CURRENT = Preset(
    "current",
    unknown="n/a",
    unknown_line="n/a",
    countries=dict(COUNTRY_GERMANY),
    blank_country="n/a",
    typed_delivery=True,
    typed_bronze=True,
    latest_customer=True,
    end_mode="recompute",
    repair_amounts=True,
    decode_birth_gender=True,
    null_future_births=True,
    maintenance_as_flag=False,
    with_age=False,
    current_products=True,
)
PRESETS = {p.name: p for p in (INCREMENTAL, REBUILT, CURRENT)}

__all__ = ["Preset", "INCREMENTAL", "REBUILT", "CURRENT", "PRESETS", "replace"]
