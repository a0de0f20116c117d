"""Queries of the package against their SQL on DuckDB."""

import pytest

from sedimenta.llm.queries import EXPECTED, QUERIES
from sedimenta.plans.registry import Query
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query(spark, con, sf, name):
    assert compare(spark, con, Query(name, QUERIES[name], EXPECTED[name]), sf) is None
