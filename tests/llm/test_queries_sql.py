"""Queries of the subpackage against their SQL twins, and the rest for their shape."""

import oracle
import pytest

import __spark_entry__ as driver
from salesloom.llm.oracles import ORACLES
from salesloom.llm.queries import QUERIES

SF = f"{oracle.TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_all_are_registered():
    assert set(ORACLES) <= set(QUERIES) and set(QUERIES) <= set(driver.queries())
    assert "pipeline" in driver.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None
