"""Every registered query of the library against its SQL."""

import pytest

from harborline.registry import ORACLE, QUERIES
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    compare(QUERIES[name](spark, sf), con, ORACLE[name])
