"""Every query of the library against its SQL twin on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as driver
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = f"{oracle.TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = driver.queries()[name](spark, SF)
    assert oracle.difference(df, con, driver.oracle_sql()[name]) is None
