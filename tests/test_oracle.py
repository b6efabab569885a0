"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import pytest

from verification.compare import database, differences
from verification.oracle import oracle_sql
from verification.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return database(SF)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_sql(spark, duck, name):
    _, problems = differences(queries()[name](spark, SF), duck, oracle_sql()[name])
    assert not problems


def test_entry(spark):
    import __spark_entry__ as driver

    found = driver.entry(spark)
    assert found.count() == 20 and "risk_score" in found.columns
    assert set(queries()) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())
