"""Every registered query against its expected SQL."""

import pytest

import __spark_entry__ as driver
from sedimenta.plans import QUERIES
from tests.oracle import compare

ROWS_ONLY = {"A6_format_sizes", "M1_plan_profile", "M3_z_order_file_spans"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    assert compare(spark, con, QUERIES[name], sf) is None


def test_only_layout_reports_lack_expected_sql():
    assert {name for name, q in QUERIES.items() if q.expected is None} == ROWS_ONLY
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) - ROWS_ONLY <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
