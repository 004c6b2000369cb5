"""Every registered query against its SQL on the smallest given tables."""

import pytest

from checks.catalog import ORACLES, QUERIES
from checks.compare import compare, connect
from checks.frames import Frames

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(name, Frames(spark, SF), con)
    assert ok, note
