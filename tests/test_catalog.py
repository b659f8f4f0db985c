import pytest

import __spark_entry__ as entry
from broadsheet.plans import catalog
from tests.oracle import same


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    same(spark, catalog.QUERIES[name], catalog.ORACLE_SQL[name])


def test_entry_and_registries(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_queries_without_sql_give_rows(spark, name):
    assert catalog.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
