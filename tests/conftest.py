import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "orderloom-tests",
        master="local[8]",
        shuffle_partitions=4,
        extra={
            "spark.checkpoint.dir": shared,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": f"{shared}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    data = [tuple(r) for r in df.collect()]
    return sorted(data, key=lambda r: tuple((v is not None, str(v)) for v in r)) if not order else data


@pytest.fixture(scope="session")
def as_rows():
    return rows
