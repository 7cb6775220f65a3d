import pytest
from compare import both

from gridloom.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    a, b = both(spark, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name], FOLDER)
    assert a == b


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
