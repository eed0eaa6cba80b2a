"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as registered
from compare import differences, open_tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = registered.oracles.oracle_sql()
# The corpus queries have tests of their own.
QUERIES = registered.registered.queries()


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF_DIR)


def test_twins_belong_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_twin(spark, tables, name):
    assert differences(QUERIES[name](spark, SF_DIR), tables, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_twin_has_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["accepted_rows", "featured_rows", "quality_report", "roc_auc_exact", "top_errors"]
)
def test_plans_stay_in_the_jvm(spark, plan, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for word in ("EvalPython", "MapInPandas", "CartesianProduct"):
        assert word not in text
