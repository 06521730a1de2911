"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tests.compare import connect, mismatch
from tidelog.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, sf, con, name):
    assert name in ORACLES
    assert mismatch(driver.queries()[name](spark, sf), ORACLES[name], con) is None


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
