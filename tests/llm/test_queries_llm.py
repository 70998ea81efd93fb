"""Queries that SQL can express, against it."""

from __future__ import annotations

import pytest

from compare import differences, duckdb_rows, spark_rows
from renewlens.llm import catalog

CHECKS = catalog.oracle_sql()


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, name, folder):
    left = spark_rows(catalog.queries()[name](spark, folder))
    assert differences(left, duckdb_rows(CHECKS[name], folder)) == []


def test_all_checks_have_queries():
    assert set(CHECKS) <= set(catalog.queries())
