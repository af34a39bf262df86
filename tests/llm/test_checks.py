"""Operators whose whole result SQL can express, against that SQL on the smallest tables."""

import os

import pytest

from orderloom.llm.catalog import CHECKS, QUERIES
from tests.compare import connect, difference

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_check(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, CHECKS[name]) is None
