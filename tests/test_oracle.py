"""Every check query against its SQL oracle on the smallest data set."""

import pytest

from checks.compare import compare, duck
from checks.oracle import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, name)
    assert ok, note
