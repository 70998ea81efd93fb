"""Every named query against its SQL check, on whole tables."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import differences, duckdb_rows, spark_rows
from renewlens import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Queries added by an optional subpackage have their own tests.
QUERIES = {k: v for k, v in entry_point.queries().items() if k in catalog.queries()}
CHECKS = {k: v for k, v in entry_point.oracle_sql().items() if k in QUERIES}
UNCHECKED = {"freshness", "model_metrics", "feature_importance", "training_status", "churn_scores"}


def test_only_fits_and_file_times_lack_a_check():
    assert set(QUERIES) - set(CHECKS) == UNCHECKED
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, name):
    left = spark_rows(QUERIES[name](spark, FOLDER))
    assert differences(left, duckdb_rows(CHECKS[name], FOLDER)) == []


@pytest.mark.parametrize("name", sorted(UNCHECKED))
def test_unchecked_query_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() == 15
