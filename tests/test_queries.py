"""Every registered query against its SQL twin on the smallest data."""

import pytest
from conftest import DATA

from checks import compare
from checks.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return compare.connect(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    line = compare.check(spark, con, DATA, name, QUERIES[name])
    assert not line.startswith("FAIL"), line


def test_every_query_has_a_twin():
    assert [n for n, q in QUERIES.items() if q.sql is None] == []
