"""Corpus queries against their SQL twins; every other one has rows."""

import pytest

from compare import differences, open_tables
from tidemark.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_twin(spark, name):
    assert differences(catalog.queries()[name](spark, SF), open_tables(SF),
                       catalog.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_twin_has_rows(spark, name):
    assert not catalog.queries()[name](spark, SF).isEmpty()


def test_one_query_for_each_operator():
    names = list(catalog.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
