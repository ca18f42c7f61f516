"""Every registered query against independent SQL, over the smallest shared test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registry
from repopulse.checks.compare import connect, differences
from repopulse.checks.oracle import ORACLE
from repopulse.checks.queries import registered

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def engine():
    return connect(SF_DIR)


def test_each_query_has_a_counterpart():
    assert set(registered()) == set(ORACLE)
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_same_rows(spark, engine, name):
    query, sql = registry.queries()[name], registry.oracle_sql()[name]
    assert differences(spark, engine, SF_DIR, query, sql) is None


def test_entry(spark):
    assert registry.entry(spark).count() > 0
