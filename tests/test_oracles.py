import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, differences

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMOKE)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, name, queries()[name], oracle_sql()[name], con, SMOKE) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_has_rows(spark, name):
    assert queries()[name](spark, SMOKE).count() > 0


def test_entry(spark):
    report = entry(spark)
    assert report.columns[:2] == ["host", "hour_md5"] and report.count() > 0
