"""Every registered query with a SQL check gives the same rows as an independent engine."""

import pytest

import __spark_entry__
import oracle

SF = "/root/testdata/sf0.001"
CHECKS = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, con, name):
    difference = oracle.compare(__spark_entry__.queries()[name](spark, SF), con, CHECKS[name])
    assert difference is None, difference


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_unchecked_queries_run(spark):
    for name, build in __spark_entry__.queries().items():
        if name not in CHECKS:
            assert build(spark, SF).count() > 0
