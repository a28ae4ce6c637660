"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.registry import ORACLES, QUERIES
from checks.compare import connect, difference
from conftest import SF_DIR


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, oracle, name):
    assert difference(spark, oracle, name, SF_DIR) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["step_no", "step", "rows"] and df.count() == 10


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
