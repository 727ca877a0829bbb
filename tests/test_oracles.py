"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from scanledger import queries as registered
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in entry.queries().items() if name in registered.queries()}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in registered.queries()}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_registry():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_samples_are_repeatable(spark):
    first = QUERIES["sample_slots"](spark, SF_DIR).collect()
    assert sorted(first) == sorted(QUERIES["sample_slots"](spark, SF_DIR).collect())
    assert len(first) == 40 and len({(r.collection, r.slot) for r in first}) == 40
    for r in QUERIES["sample_windows"](spark, SF_DIR).collect():
        assert 0 <= r.y0 < 2945 and 0 <= r.x0 < 7745
