"""Every registered query against its SQL in an independent engine, on the smallest tables."""

import pytest

from checks.compare import difference, oracle_connection
from checks.oracles import ORACLES
from checks.registry import QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, oracle, name):
    ours = QUERIES[name](spark, SF).toPandas()
    assert difference(ours, oracle.execute(ORACLES[name]).df()) == ""
