"""Every registered query beside its SQL, on the smallest data set."""

import pytest
from compare import connect, difference, duck_result, spark_result

from registry import oracles
from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ORACLE = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    ours = spark_result(QUERIES[name](spark, SF_DIR))
    assert difference(ours, duck_result(duck, ORACLE[name])) is None
    assert ours[1]
