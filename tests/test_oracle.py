import pytest

import __spark_entry__ as entry
from conftest import SF_DIR
from oracle_compare import connect, difference


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    result = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert result.count() >= 0
    else:
        assert difference(result, con, sql) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
