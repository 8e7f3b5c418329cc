import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from tagloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture
def skewed(spark):
    """Split keys from few rows on, so that small inputs have hot keys."""
    spark.conf.set("tagloom.rowsPerTask", "20")
    yield spark
    spark.conf.unset("tagloom.rowsPerTask")
