"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    if name not in oracle_sql():
        pytest.skip("compared with a brute-force version in its own tests")
    got = queries()[name](spark, FOLDER).toPandas()
    assert len(got), "a comparison of no rows proves nothing"
    if name == "district_extremes":
        assert set(got["extreme"]) == {0, 1}
    if name == "district_route":
        assert set(got["method"]) == {"buildings", "multiplier"}
    assert difference(got, con.sql(oracle_sql()[name]).df()) is None


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries())
    assert {n for n in queries() if n not in oracle_sql()} <= {"pipeline", *(n for n in queries() if n.startswith("op"))}
    assert entry(spark).count() > 0
