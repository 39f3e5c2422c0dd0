import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from locusframe.session import local_session

    session = local_session("4", "tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df, *columns):
    """Sorted tuples of a small result."""
    return sorted(tuple(r) for r in df.select(*columns).collect())
