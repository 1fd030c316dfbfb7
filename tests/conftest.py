import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snaptide.scratch import work_area  # noqa: E402
from snaptide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "snaptide-tests")
    yield session
    session.stop()


@pytest.fixture
def area(spark):
    return work_area(spark, "test")


def rows(df):
    """Rows of a frame as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
