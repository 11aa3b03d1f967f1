"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from checks.compare import duckdb_rows, spark_rows
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SF_DIR


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == duckdb_rows(ORACLES[name], SF_DIR)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
