"""Every registered query against its check SQL on the smallest tables."""

import os

import pytest

from orderloom.plans.catalog import CHECKS, QUERIES
from tests.compare import connect, difference

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in CHECKS:
        assert difference(df, con, CHECKS[name]) is None
    else:
        assert df.count() > 0


def test_flagship_values(spark):
    """Figures of the deduplicated log at the next scale factor."""
    bigger = "/root/testdata/sf0.01"
    if not os.path.isdir(bigger):
        pytest.skip("tables not present")
    got = {r["order_main_category"]: r for r in QUERIES["return_rate_by_category"](spark, bigger).collect()}
    assert got["automobile"]["return_rate"] == 0.3334845735027223 and got["automobile"]["n"] == 8816
    assert got["machinery"]["n"] == 9344
