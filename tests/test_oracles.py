"""Every query of the set against its reference SQL."""

import pytest
from check_oracles import compare, connect
from conftest import SF

from lamina.plans import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    if key in ORACLES:
        assert compare(spark, con, QUERIES[key], ORACLES[key], SF) is None
    else:
        assert QUERIES[key](spark, SF).count() > 0


def test_every_reference_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
