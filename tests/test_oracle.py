"""Every registered query equals its DuckDB oracle (row count, columns, values)."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from shiftmetrics.registry import ALL_QUERIES

# SHIFTMETRICS_TEST_SF=/root/testdata/sf0.01 runs the comparison at the driver's scale.
SF = os.environ.get("SHIFTMETRICS_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    # (The text operators have SQL only where SQL can express them.)
    assert set(ALL_QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["report_date", "t1_00_08", "t2_08_16", "t3_16_24", "total"]
    assert df.count() > 0
