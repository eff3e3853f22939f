import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from registry.scratch import local_scratch  # noqa: E402
from stockweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_scratch(local_session("4", "4g"))


@pytest.fixture
def rows():
    """Collect a frame as a sorted list of tuples."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted(tuple(r) for r in picked.collect())

    return collect
