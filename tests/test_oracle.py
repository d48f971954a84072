"""Every SQL-checkable registered query equals its DuckDB oracle (sf0.001)."""

import pytest

from tabrisk.plans.catalog import ORACLE, QUERIES

from oracle_check import compare

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(spark, name, SMOKE, QUERIES, ORACLE)
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
