"""Every query over position views against DuckDB."""

import pytest

import __spark_entry__ as entry
from fairlead.plans.oracle import ORACLE
from fairlead.plans.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, same_as_sql):
    same_as_sql(QUERIES[name], ORACLE[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())
