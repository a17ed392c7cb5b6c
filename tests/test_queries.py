"""Every registered query against its SQL on a second engine."""

import pytest

import __spark_entry__ as entry
from compare import database, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return database(SF_DIR)


LIBRARY = {**entry.tables.table_queries(), **entry.streams.stream_queries()}


def test_every_query_has_sql():
    assert LIBRARY.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


@pytest.mark.parametrize("name", LIBRARY)
def test_same_as_sql(spark, sql, name):
    result = entry.queries()[name](spark, SF_DIR).toPandas()
    assert differences(result, sql.execute(entry.oracle_sql()[name]).df()) is None
    assert len(result)
