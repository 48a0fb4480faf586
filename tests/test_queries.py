"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks.all_queries import QUERIES, SQL
from checks.compare import compare, duck

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    result = compare(QUERIES[name](spark, SF), con.execute(SQL[name]))
    assert result.startswith("ok"), result


def test_flagship_fills_every_target(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.count() == 390 and out.filter("visitors IS NULL").count() == 0
