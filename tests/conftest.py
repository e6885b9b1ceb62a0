import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shiftloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, app="shiftloom-tests")


@pytest.fixture
def one(spark):
    """Value of a column expression over one literal."""

    def run(fn, value, kind="string"):
        row = spark.createDataFrame([(value,)], f"v {kind}").select(fn("v").alias("out")).first()
        return row["out"]

    return run
