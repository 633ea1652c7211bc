"""Queries with SQL counterparts, over the provided tables."""

import pytest

import __spark_entry__ as registered
from check import difference, duck
from conftest import SF
from visitmart.llm import queries, sql


@pytest.mark.parametrize("name", sorted(sql.STATEMENTS))
def test_equals_sql(spark, name):
    assert difference(spark, duck(SF), name, SF) is None


def test_all_are_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) <= set(registered.queries()) and set(sql.STATEMENTS) <= set(registered.oracle_sql())
