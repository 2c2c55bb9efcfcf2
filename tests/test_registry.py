"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry
import compare

from terrace.registry import entries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.tables(SF_DIR)


# The daily run is what tests/test_warehouse.py is about.
COMPARED = sorted(set(entries()) - {"daily_run_row_counts"})


@pytest.mark.parametrize("name", COMPARED)
def test_query_agrees_with_sql(spark, con, name):
    assert compare.difference(spark, con, name, SF_DIR) is None


def test_entry_gives_the_fact(spark):
    df = entry.entry(spark)
    assert "sales_key" in df.columns and df.count() > 0


def test_only_file_facts_have_no_sql():
    assert {name for name, (_, sql) in entries().items() if not sql} == {"source_file_facts"}
