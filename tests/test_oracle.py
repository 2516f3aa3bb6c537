"""Every query against its SQL, at the smallest scale."""

import os

import pytest

from checks.compare import rows_of, views
from checks.registry import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return views(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    expected = duck.execute(ORACLE[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows_of(found) == rows_of(expected)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
