import pytest

import __spark_entry__ as entry_points
import compare
from txnwatch.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.registry(), oracle.oracles()


@pytest.fixture(scope="module")
def duck():
    with compare.connect(SF) as con:
        yield con


def test_every_query_has_its_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = compare.both(spark, duck, QUERIES[name], ORACLES[name], SF)
    assert ours == theirs


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
