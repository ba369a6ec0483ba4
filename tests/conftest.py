from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from paperloom.session import local_session

    session = local_session(8, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluate one column of constants on a row that the optimizer cannot fold away."""

    def run(column):
        return spark.range(1).select(column.alias("x")).first()[0]

    return run
