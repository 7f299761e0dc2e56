"""Every registered query against its SQL, on two sizes, and twice for repeatability."""

import pytest

import __spark_entry__ as entry
from registered import ORACLES, QUERIES
from tests.oracle import compare, connect

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module", params=[SMALL, LARGER])
def folder(request):
    return request.param


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, folder, name):
    found = QUERIES[name](spark, folder).toPandas()
    expected = connect(folder).execute(ORACLES[name]).df()
    assert compare(found, expected) is None
    assert len(found) > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
